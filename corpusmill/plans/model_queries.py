"""Typed features (F1-F9, F11), count models (M1, M2, M4, M5, M7-M9), MLlib (M3)
and metrics (E1, E4, E5, E7) on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import classify as cl
from corpusmill.operators import evaluate as ev
from corpusmill.operators import features as fx
from corpusmill.operators import prep
from corpusmill.operators.ordered import last_k_before
from corpusmill.plans import sql as q
from corpusmill.plans.registry import load, register
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources import store

# ---- features ---------------------------------------------------------------------

LINEITEM_SPEC = fx.FeatureSpec(
    {
        "l_quantity": fx.Numerical((1.0, 40.0), 10),
        "l_discount": fx.Numerical((0.0, 0.08), 8),
        "l_linenumber": fx.Categorical(n_classes=6, type="int"),
        "l_returnflag": fx.Categorical(),
        "l_shipdate": fx.Date(),
    },
    target="l_returnflag",
)


@register(
    "validate_lineitem",
    """SELECT * FROM (VALUES
      ('l_quantity', (SELECT count(*) FROM lineitem WHERE l_quantity IS NULL OR l_quantity < 1 OR l_quantity > 40)),
      ('l_discount', (SELECT count(*) FROM lineitem WHERE l_discount IS NULL OR l_discount < 0 OR l_discount > 0.08)),
      ('l_linenumber', (SELECT count(*) FROM lineitem WHERE l_linenumber IS NULL OR l_linenumber < 0 OR l_linenumber >= 6)),
      ('l_returnflag', (SELECT count(*) FROM lineitem WHERE l_returnflag IS NULL)),
      ('l_shipdate', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL))) t(column_name, violations)""",
)
def validate_lineitem(spark, sf):
    return fx.validate(load(spark, sf, "lineitem"), LINEITEM_SPEC)


@register(
    "numeric_bins_lineitem",
    """SELECT l_orderkey, l_linenumber,
              round((least(greatest(l_extendedprice, 1000.0), 100000.0) - 1000.0) / 99000.0, 6) AS scaled,
              least(floor((least(greatest(l_extendedprice, 1000.0), 100000.0) - 1000.0) / 99000.0 * 20), 19)::BIGINT AS bin
       FROM lineitem""",
)
def numeric_bins_lineitem(spark, sf):
    scaled, b = fx.numerical("l_extendedprice", 1000.0, 100000.0, 20)
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(scaled, 6).alias("scaled"), b.alias("bin"))


@register("categorical_codes_part", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_code FROM part")
def categorical_codes_part(spark, sf):
    part = load(spark, sf, "part")
    d = fx.categorical_dictionary(part, "p_brand")
    return fx.encode(part, "p_brand", d).select("p_partkey", "p_brand_code")


@register(
    "class_names_part",
    """SELECT p_partkey, c.p_type AS class_name FROM part
       JOIN (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part)) c USING (p_type)""",
)
def class_names_part(spark, sf):
    part = load(spark, sf, "part")
    d = fx.categorical_dictionary(part, "p_type")
    coded = fx.encode(part, "p_type", d, "code")
    return fx.class_name(coded, "code", d).select("p_partkey", "class_name")


@register(
    "multi_label_part",
    """SELECT p_partkey, label, dense_rank() OVER (ORDER BY label) - 1 AS code FROM
       (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part) WHERE label <> ''""",
)
def multi_label_part(spark, sf):
    part = load(spark, sf, "part")
    ml = fx.multi_label(part, "p_partkey", "p_name", " ")
    d = fx.categorical_dictionary(ml, "label")
    return fx.encode(ml, "label", d, "code").select("p_partkey", "label", "code")


@register(
    "text_features_benchmark",
    f"""WITH t AS (SELECT item_id, {q.tok('text')} AS w FROM benchmark),
f AS (
  SELECT item_id, 'w:' || unnest(w) AS feature FROM t
  UNION ALL SELECT item_id, 'n:' || w[i] || ' ' || w[i + 1] FROM (SELECT item_id, w, unnest(range(1, len(w))) AS i FROM t)
  UNION ALL SELECT item_id, 'c:' || CASE WHEN length(x) <= 3 THEN x ELSE substring(x, j, 3) END FROM
     (SELECT item_id, x, unnest(range(1, greatest(length(x) - 1, 2)::BIGINT)) AS j FROM (SELECT item_id, unnest(w) AS x FROM t)))
SELECT item_id, feature, count(*) AS n FROM f GROUP BY item_id, feature""",
)
def text_features_benchmark(spark, sf):
    return fx.text_features(load(spark, sf, "benchmark"), "item_id", "text", 2, 3)


@register(
    "date_parts_events",
    "SELECT event_id, isodow(ts)::BIGINT AS dow, day(ts)::BIGINT AS dom, week(ts)::BIGINT AS week, month(ts)::BIGINT AS month FROM events",
)
def date_parts_events(spark, sf):
    return load(spark, sf, "events").select("event_id", *fx.date_parts("ts"))


@register(
    "hash_features_orders",
    f"""SELECT o_orderkey, {q.shash('f')} % 1024 AS bucket, count(*) AS n FROM (
          SELECT o_orderkey, unnest(['o_orderstatus=' || coalesce(o_orderstatus, ''), 'o_orderpriority=' || coalesce(o_orderpriority, ''),
                                     'o_custkey=' || coalesce(CAST(o_custkey AS VARCHAR), '')]) AS f FROM orders)
        GROUP BY o_orderkey, bucket""",
)
def hash_features_orders(spark, sf):
    return fx.hash_features(load(spark, sf, "orders"), "o_orderkey", ["o_orderstatus", "o_orderpriority", "o_custkey"], 1024)


@register(
    "cross_columns_orders",
    """SELECT o_orderkey, concat_ws('|', o_orderstatus, o_orderpriority) AS o_orderstatus__o_orderpriority,
              concat_ws('|', o_orderstatus, CAST(o_custkey AS VARCHAR)) AS o_orderstatus__o_custkey,
              concat_ws('|', o_orderpriority, CAST(o_custkey AS VARCHAR)) AS o_orderpriority__o_custkey FROM orders""",
)
def cross_columns_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    return fx.cross_columns(o, ["o_orderstatus", "o_orderpriority", "o_custkey"]).drop("o_orderstatus", "o_orderpriority", "o_custkey")


@register(
    "track_events",
    """SELECT event_id, coalesce(array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), ' '), '') AS history FROM events""",
)
def track_events(spark, sf):
    e = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    t = last_k_before(e, "user_id", ["ts", "event_id"], 3, "event_type", chunk_rows=1000)
    return t.select("event_id", F.array_join("history", " ").alias("history"))


# ---- count models --------------------------------------------------------------------

def labelled_docs(spark, sf):
    return load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def train_part(df, seed=11, share=0.8):
    return df.filter(prep.hash_bucket("doc_id", seed) < int(share * 1_000_000))


QUALITY_TRAIN = f"SELECT l.doc_id AS row_id, CAST(l.quality AS VARCHAR) AS label, d.text FROM labels l JOIN documents d USING (doc_id) WHERE {q.bucket(11, 'l.doc_id')} < 800000"
QUALITY_ALL = "SELECT l.doc_id AS row_id, d.text FROM labels l JOIN documents d USING (doc_id)"
NB_QUALITY_SQL = f"WITH {q.nb_ctes(QUALITY_TRAIN, QUALITY_ALL)} SELECT row_id AS doc_id, label, score, prob FROM ({q.nb_top(1)})"


def _nb_out(p):
    return p.select(F.col("row_id").alias("doc_id"), "label", "score", "prob")


@register("nb_quality", NB_QUALITY_SQL)
def nb_quality(spark, sf):
    ld = labelled_docs(spark, sf)
    m = cl.fit_text(train_part(ld), "doc_id", "text", "quality")
    return _nb_out(cl.predict(m, ld, "doc_id", "text", 1))


@register("nb_saved_model", NB_QUALITY_SQL)
def nb_saved_model(spark, sf):
    """Train, store, reload, predict."""
    ld = labelled_docs(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    store.save_model(cl.fit_text(train_part(ld), "doc_id", "text", "quality"), path)
    return _nb_out(cl.predict(store.load_model(spark, path, cl.CountModel), ld, "doc_id", "text", 1))


@register("nb_fine_tune", NB_QUALITY_SQL)
def nb_fine_tune(spark, sf):
    """M5: fit on one half of the training rows, fine-tune on the other at weight 1 = joint fit."""
    ld = labelled_docs(spark, sf)
    tr = train_part(ld)
    half = prep.hash_bucket("doc_id", 13) < 500_000
    m = cl.fine_tune(cl.fit_text(tr.filter(half), "doc_id", "text", "quality"), tr.filter(~half), "doc_id", "text", "quality", 1.0)
    return _nb_out(cl.predict(m, ld, "doc_id", "text", 1))


@register("nb_in_batches", NB_QUALITY_SQL)
def nb_in_batches(spark, sf):
    """M7: four bounded batches folded = one fit."""
    ld = labelled_docs(spark, sf)
    tr = train_part(ld).withColumn("_b", F.pmod(prep.stable_hash(F.col("doc_id")), F.lit(4)))
    m = cl.fit_in_batches([tr.filter(F.col("_b") == i) for i in range(4)], "doc_id", "text", "quality")
    return _nb_out(cl.predict(m, ld, "doc_id", "text", 1))


@register("nb_parallel_16", NB_QUALITY_SQL)
def nb_parallel_16(spark, sf):
    """M8: same counts whatever the partitioning (16 partitions here)."""
    ld = labelled_docs(spark, sf)
    m = cl.fit_text(train_part(ld).repartition(16), "doc_id", "text", "quality")
    return _nb_out(cl.predict(m, ld, "doc_id", "text", 1))


LANG_TRAIN = f"SELECT doc_id AS row_id, lang AS label, text FROM documents WHERE {q.bucket(5, 'doc_id')} < 800000"
LANG_TEST = f"SELECT doc_id AS row_id, text FROM documents WHERE {q.bucket(5, 'doc_id')} >= 800000"


@register("nb_lang_top2", f"WITH {q.nb_ctes(LANG_TRAIN, LANG_TEST)} SELECT row_id AS doc_id, label, score, prob, rank FROM ({q.nb_top(2)})")
def nb_lang_top2(spark, sf):
    d = load(spark, sf, "documents")
    tr = d.filter(prep.hash_bucket("doc_id", 5) < 800_000)
    te = d.filter(prep.hash_bucket("doc_id", 5) >= 800_000)
    m = cl.fit_text(tr, "doc_id", "text", "lang")
    p = cl.predict(m, te, "doc_id", "text", 2)
    return p.select(F.col("row_id").alias("doc_id"), "label", "score", "prob", "rank")


@register(
    "quality_accuracy",
    f"""WITH {q.nb_ctes(QUALITY_TRAIN, QUALITY_ALL)}, top AS ({q.nb_top(1)})
        SELECT round(avg(CASE WHEN top.label = CAST(l.quality AS VARCHAR) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM labels l LEFT JOIN top ON top.row_id = l.doc_id WHERE {q.bucket(11, 'l.doc_id')} >= 800000""",
)
def quality_accuracy(spark, sf):
    ld = labelled_docs(spark, sf)
    m = cl.fit_text(train_part(ld), "doc_id", "text", "quality")
    test = ld.filter(prep.hash_bucket("doc_id", 11) >= 800_000)
    p = cl.predict(m, test, "doc_id", "text", 1).select(F.col("row_id").alias("doc_id"), F.col("label").alias("pred"))
    return ev.categorical_accuracy(p, test.withColumn("quality", F.col("quality").cast("string")), "doc_id", "pred", "quality")


@register(
    "quality_log_loss",
    f"""WITH {q.nb_ctes(QUALITY_TRAIN, QUALITY_ALL)}
        SELECT round(avg(-ln(greatest(pr.prob, 1e-15))), 6) AS log_loss FROM labels l
        JOIN pr ON pr.row_id = l.doc_id AND pr.label = CAST(l.quality AS VARCHAR) WHERE {q.bucket(11, 'l.doc_id')} >= 800000""",
)
def quality_log_loss(spark, sf):
    ld = labelled_docs(spark, sf)
    m = cl.fit_text(train_part(ld), "doc_id", "text", "quality")
    test = ld.filter(prep.hash_bucket("doc_id", 11) >= 800_000)
    p = cl.predict(m, test, "doc_id", "text", 2)
    truth = p.join(test.select(F.col("doc_id").alias("row_id"), F.col("quality").cast("string").alias("label")), ["row_id", "label"])
    return ev.log_loss(truth, "prob")


@register(
    "compare_runs",
    f"""WITH {q.nb_ctes(QUALITY_TRAIN, QUALITY_ALL)}, top AS ({q.nb_top(1)})
        SELECT 'naive_bayes' AS run, round(avg(CASE WHEN top.label = CAST(l.quality AS VARCHAR) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM labels l LEFT JOIN top ON top.row_id = l.doc_id WHERE {q.bucket(11, 'l.doc_id')} >= 800000
        UNION ALL
        SELECT 'majority', round(avg(CASE WHEN CAST(l.quality AS VARCHAR) = (SELECT CAST(quality AS VARCHAR) FROM labels
                WHERE {q.bucket(11, 'doc_id')} < 800000 GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1) THEN 1.0 ELSE 0.0 END), 6)
        FROM labels l WHERE {q.bucket(11, 'l.doc_id')} >= 800000""",
)
def compare_runs(spark, sf):
    """One metric over two systems (the count model and the majority class)."""
    ld = labelled_docs(spark, sf)
    tr = train_part(ld)
    test = ld.filter(prep.hash_bucket("doc_id", 11) >= 800_000).withColumn("quality", F.col("quality").cast("string"))
    m = cl.fit_text(tr, "doc_id", "text", "quality")
    p = cl.predict(m, test, "doc_id", "text", 1).select(F.col("row_id").alias("doc_id"), F.col("label").alias("pred"))
    top = tr.groupBy(F.col("quality").cast("string").alias("pred")).count().orderBy(F.desc("count"), "pred").limit(1).select("pred")
    maj = test.select("doc_id", F.lit(top.first()["pred"]).alias("pred"))
    return ev.compare(
        {
            "naive_bayes": ev.categorical_accuracy(p, test, "doc_id", "pred", "quality"),
            "majority": ev.categorical_accuracy(maj, test, "doc_id", "pred", "quality"),
        }
    )


MULTI_TRAIN_POS = """SELECT l.doc_id AS row_id, lab AS label, d.text FROM labels l JOIN documents d USING (doc_id),
    (SELECT unnest(['quality', 'toxic']) AS lab) x WHERE (lab = 'quality' AND l.quality = 1) OR (lab = 'toxic' AND l.toxic = 1)"""


def _multilabel_sql():
    return f"""WITH {q.nb_ctes(MULTI_TRAIN_POS, QUALITY_ALL)},
alltr AS (SELECT l.doc_id AS row_id, d.text FROM labels l JOIN documents d USING (doc_id)),
atk AS (SELECT row_id, unnest({q.tok('text')}) AS term FROM alltr),
atc AS (SELECT term, count(*)::DOUBLE AS n_all FROM atk GROUP BY term),
atot AS (SELECT (SELECT count(*) FROM alltr)::DOUBLE AS n, (SELECT count(*) FROM atk)::DOUBLE AS len, (SELECT count(*) FROM atc)::DOUBLE AS v),
kn2 AS (SELECT st.* , atc.n_all FROM st JOIN atc USING (term)),
l2 AS (SELECT row_id, sum(cnt) AS L FROM kn2 GROUP BY row_id),
b2 AS (SELECT r.row_id, cc.label, (ln(cc.docs) - ln(atot.n - cc.docs)) + coalesce(l2.L, 0) * (ln(atot.len - cc.len + atot.v) - ln(cc.len + atot.v)) AS s
       FROM (SELECT DISTINCT row_id FROM te) r LEFT JOIN l2 USING (row_id) CROSS JOIN cc CROSS JOIN atot),
bo2 AS (SELECT kn2.row_id, cc.label, sum(kn2.cnt * (ln(coalesce(tc.n, 0) + 1) - ln(kn2.n_all - coalesce(tc.n, 0) + 1))) AS b
        FROM kn2 CROSS JOIN cc LEFT JOIN tc ON tc.term = kn2.term AND tc.label = cc.label GROUP BY kn2.row_id, cc.label)
SELECT b2.row_id AS doc_id, b2.label, round(s + coalesce(b, 0), 4) AS score FROM b2 LEFT JOIN bo2 USING (row_id, label)"""


@register("nb_multilabel", _multilabel_sql())
def nb_multilabel(spark, sf):
    ld = labelled_docs(spark, sf).withColumn(
        "labels", F.filter(F.array(F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic")), lambda x: x.isNotNull())
    )
    fitted = cl.fit_multilabel(ld, "doc_id", "text", "labels")
    return cl.predict_multilabel(fitted, ld, "doc_id", "text").select(F.col("row_id").alias("doc_id"), "label", "score")


# ---- tabular (M4) and AUC (E4) -------------------------------------------------------------

def _li_features():
    q_ = fx.numerical("l_quantity", 1.0, 50.0, 10)[1]
    d_ = fx.numerical("l_discount", 0.0, 0.1, 10)[1]
    t_ = fx.numerical("l_tax", 0.0, 0.08, 8)[1]
    return {"qty": q_, "disc": d_, "tax": t_, "status": F.col("l_linestatus"), "month": F.month("l_shipdate")}


def _li_sql_terms():
    qb = "least(floor((least(greatest(l_quantity, 1.0), 50.0) - 1.0) / 49.0 * 10), 9)::BIGINT"
    db = "least(floor((least(greatest(l_discount, 0.0), 0.1) - 0.0) / 0.1 * 10), 9)::BIGINT"
    tb = "least(floor((least(greatest(l_tax, 0.0), 0.08) - 0.0) / 0.08 * 8), 7)::BIGINT"
    return f"""['qty=' || CAST({qb} AS VARCHAR), 'disc=' || CAST({db} AS VARCHAR), 'tax=' || CAST({tb} AS VARCHAR),
               'status=' || l_linestatus, 'month=' || CAST(month(l_shipdate) AS VARCHAR)]"""


_CENTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ROW_SQL = q.shash(
    "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"CAST(round({c} * 100) AS BIGINT)" for c in _CENTS)
    + ", l_returnflag, l_linestatus, year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate))"
)


def li_row_id():
    """lineitem has no key column, so its split into parts goes by a stable hash of
    all values of a row (numbers in hundredths, the date as yyyymmdd)."""
    parts = [F.col(c).cast("string") for c in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]]
    parts += [F.round(F.col(c) * 100).cast("bigint").cast("string") for c in _CENTS]
    parts += [F.col("l_returnflag"), F.col("l_linestatus"),
              (F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.dayofmonth("l_shipdate")).cast("string")]
    return prep.stable_hash(F.concat_ws(":", *parts))


def _tabular_sql(k: int):
    """Rows are numbered, so equal rows stay apart."""
    train = (f"SELECT row_id, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label, {_li_sql_terms()} AS text "
             f"FROM li WHERE {q.bucket(21, LI_ROW_SQL)} < 800000")
    score = f"SELECT row_id, {_li_sql_terms()} AS text FROM li"
    return f"""WITH li AS MATERIALIZED (SELECT row_number() OVER () AS row_id, * FROM lineitem), {q.nb_ctes(train, score, lambda x: x)}
        SELECT li.l_orderkey, li.l_linenumber, li.l_returnflag, p.label, p.score, p.prob FROM ({q.nb_top(k)}) p JOIN li USING (row_id)"""


def _tabular(spark, sf, k):
    li = load(spark, sf, "lineitem")
    feats = _li_features()
    train = li.withColumn("_row", li_row_id()).filter(prep.hash_bucket("_row", 21) < 800_000).withColumn("label", F.when(F.col("l_returnflag") == "R", "1").otherwise("0"))
    return cl.predict_tabular(cl.fit_tabular(train, feats, "label"), li, ["l_orderkey", "l_linenumber", "l_returnflag"], feats, k)


@register("tabular_returnflag", f"SELECT l_orderkey, l_linenumber, label, score, prob FROM ({_tabular_sql(1)})")
def tabular_returnflag(spark, sf):
    return _tabular(spark, sf, 1).select("l_orderkey", "l_linenumber", "label", "score", "prob")


@register(
    "roc_auc_discount",
    """WITH g AS (SELECT l_discount + 0.0 AS s, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::DOUBLE AS pos,
                         sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END)::DOUBLE AS neg FROM lineitem GROUP BY 1),
            r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)
       SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM r""",
)
def roc_auc_discount(spark, sf):
    li = load(spark, sf, "lineitem").select((F.col("l_discount") + 0.0).alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return ev.roc_auc(li, "s", "y")


@register(
    "roc_auc_tabular",
    f"""WITH p AS ({_tabular_sql(2)}),
            j AS (SELECT prob AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM p WHERE label = '1'),
            g AS (SELECT s, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM j GROUP BY s),
            r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)
       SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM r""",
)
def roc_auc_tabular(spark, sf):
    p = _tabular(spark, sf, 2).filter(F.col("label") == "1")
    return ev.roc_auc(p.select("prob", (F.col("l_returnflag") == "R").cast("int").alias("y")), "prob", "y")


# ---- MLlib (M3) -----------------------------------------------------------------------------

def _quality_features(spark, sf):
    ld = labelled_docs(spark, sf)
    n = F.greatest(F.length("text"), F.lit(1))
    return ld.select(
        "doc_id", "quality",
        (F.length(F.regexp_replace("text", r"[\p{L}\s]", "")) / n).alias("non_letter_share"),
        F.log1p(F.length("text")).alias("log_len"),
        (F.size(F.split("text", "\n")) / n * 1000).alias("lines_per_k"),
    )


@register("linear_quality")
def linear_quality(spark, sf):
    d = _quality_features(spark, sf)
    tr = d.filter(prep.hash_bucket("doc_id", 11) < 800_000)
    m = cl.fit_linear(tr, ["non_letter_share", "log_len", "lines_per_k"], "quality", 50)
    return cl.predict_linear(m, d, "doc_id")


@register("linear_quality_auc")
def linear_quality_auc(spark, sf):
    d = _quality_features(spark, sf)
    tr = d.filter(prep.hash_bucket("doc_id", 11) < 800_000)
    te = d.filter(prep.hash_bucket("doc_id", 11) >= 800_000)
    m = cl.fit_linear(tr, ["non_letter_share", "log_len", "lines_per_k"], "quality", 50)
    p = cl.predict_linear(m, te, "doc_id").join(te.select("doc_id", "quality"), "doc_id")
    return ev.roc_auc(p, "p1", "quality")


def _watched_spec():
    return fx.FeatureSpec(
        {"l_quantity": fx.Numerical((1.0, 50.0), 10), "l_extendedprice": fx.Numerical((900.0, 105000.0), 20), "l_discount": fx.Numerical((0.0, 0.1), 10),
         "l_linestatus": fx.Categorical(), "l_shipdate": fx.Date()},
        target="watched",
    )


@register("mixed_lineitem_auc")
def mixed_lineitem_auc(spark, sf):
    """M3 on numbers, a category, a date and a cross of ``lineitem``, on held-out rows.
    The columns are independent of each other, so the target is made from them: a large
    net price, or a December line of status F."""
    li = load(spark, sf, "lineitem").withColumn("month", F.month("l_shipdate"))
    large = F.col("l_extendedprice") * (1 - F.col("l_discount")) > 60000
    li = li.withColumn("watched", (large | ((F.col("month") == 12) & (F.col("l_linestatus") == "F"))).cast("int"))
    li = li.withColumn("_row", li_row_id()).withColumn("part", prep.hash_bucket("_row", 21))
    m = cl.fit_mixed(li.filter("part < 800000"), _watched_spec(), 1 << 12, [("month", "l_linestatus")], 15)
    return ev.roc_auc(cl.predict_mixed(m, li.filter("part >= 800000"), ["watched"]), "p1", "watched")


@register("mixed_quality_auc")
def mixed_quality_auc(spark, sf):
    """M3 on the text, language and length of the labelled documents, on held-out ones."""
    d = labelled_docs(spark, sf).join(load(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    spec = fx.FeatureSpec({"text": fx.Text(word_n=2), "lang": fx.Categorical(), "n_chars": fx.Numerical((0.0, 5000.0), 20)}, target="quality")
    part = prep.hash_bucket("doc_id", 11)
    m = cl.fit_mixed(d.filter(part < 800_000), spec, 1 << 16, (), 15, 1e-3)
    return ev.roc_auc(cl.predict_mixed(m, d.filter(part >= 800_000), ["quality"]), "p1", "quality")
