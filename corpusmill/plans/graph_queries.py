"""Recommendation (M10-M13), vectors (D14, D16), graph (F8, M14-M16), cold start
(M6) and reformulation (M17) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import classify as cl
from corpusmill.operators import evaluate as ev
from corpusmill.operators import features as fx
from corpusmill.operators import graph as gr
from corpusmill.operators import index as ix
from corpusmill.operators import prep
from corpusmill.operators import recommend as rc
from corpusmill.operators import reform as rf
from corpusmill.operators import vectors as vx
from corpusmill.plans import sql as q
from corpusmill.plans.prep_queries import _noisy_sql
from corpusmill.plans.registry import ORACLES, load, register
from corpusmill.sources import html

# ---- purchase history: customers buying parts, in order date order --------------------------

ORDER = ["ts", "l_orderkey", "l_linenumber", "item", "l_suppkey"]
CUTOFF = "1998-01-01"


def purchases(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item"), F.col("o_orderdate").alias("ts"), "l_orderkey", "l_linenumber", "l_suppkey"
    )


H_SQL = """SELECT o.o_custkey AS user_id, l.l_partkey AS item, o.o_orderdate AS ts, l.l_orderkey, l.l_linenumber, l.l_suppkey
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""


def _tr_sql(src: str) -> str:
    return f"""SELECT prev AS a, item AS b, count(*) AS n FROM (
      SELECT item, lag(item) OVER (PARTITION BY user_id ORDER BY ts, l_orderkey, l_linenumber, item, l_suppkey) AS prev FROM ({src}))
      WHERE prev IS NOT NULL GROUP BY 1, 2"""


def _rec_sql(model_src: str, hist_src: str, pop_src: str) -> str:
    return f"""WITH tr AS ({_tr_sql(model_src)}),
hh AS ({hist_src}),
lst AS (SELECT user_id, item AS a FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, l_orderkey DESC,
        l_linenumber DESC, item DESC, l_suppkey DESC) AS r FROM hh) WHERE r <= 3),
sc AS (SELECT user_id, b AS item, sum(n)::BIGINT AS score FROM lst JOIN tr ON tr.a = lst.a GROUP BY 1, 2),
rk AS (SELECT * FROM (SELECT user_id, item, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item) AS rank, score FROM sc) WHERE rank <= 5),
pop AS (SELECT item, count(*) AS score FROM ({pop_src}) GROUP BY item ORDER BY score DESC, item LIMIT 5),
popr AS (SELECT item, row_number() OVER (ORDER BY score DESC, item) AS rank, score FROM pop)
SELECT user_id, item, rank, score FROM rk
UNION ALL SELECT c.c_custkey AS user_id, popr.item, popr.rank, popr.score FROM customer c CROSS JOIN popr
WHERE c.c_custkey NOT IN (SELECT user_id FROM rk)"""


@register("item_transitions", _tr_sql(H_SQL))
def item_transitions(spark, sf):
    return rc.transitions(purchases(spark, sf), "user_id", "item", ORDER)


@register("popular_items", "SELECT item, count(*) AS score FROM (" + H_SQL + ") GROUP BY item ORDER BY score DESC, item LIMIT 10")
def popular_items(spark, sf):
    return rc.popular(purchases(spark, sf), "item", 10)


@register("recommend_customers", _rec_sql(H_SQL, H_SQL, H_SQL))
def recommend_customers(spark, sf):
    h = purchases(spark, sf)
    model = rc.transitions(h, "user_id", "item", ORDER)
    users = load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return rc.recommend(model, h, users, "user_id", "item", ORDER, 5, 3, rc.popular(h, "item", 5))


@register(
    "recommend_after_observe",
    _rec_sql(f"SELECT * FROM ({H_SQL}) WHERE ts < TIMESTAMP '{CUTOFF}'", H_SQL, f"SELECT * FROM ({H_SQL}) WHERE ts < TIMESTAMP '{CUTOFF}'"),
)
def recommend_after_observe(spark, sf):
    """The model is trained on the earlier history; later observations only
    change the history the recommendations start from."""
    h = purchases(spark, sf)
    before = h.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    after = h.filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    model = rc.transitions(before, "user_id", "item", ORDER)
    users = load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return rc.recommend(model, rc.observe(before, after), users, "user_id", "item", ORDER, 5, 3, rc.popular(before, "item", 5))


@register(
    "recommend_after_reset",
    f"""WITH pop AS (SELECT item, count(*) AS score FROM ({H_SQL}) GROUP BY item ORDER BY score DESC, item LIMIT 5),
        popr AS (SELECT item, row_number() OVER (ORDER BY score DESC, item) AS rank, score FROM pop)
        SELECT c.c_custkey AS user_id, popr.item, popr.rank, popr.score FROM customer c CROSS JOIN popr""",
)
def recommend_after_reset(spark, sf):
    """History dropped, model kept: every user gets the popular list."""
    h = purchases(spark, sf)
    model = rc.transitions(h, "user_id", "item", ORDER)
    users = load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return rc.recommend(model, rc.reset(h), users, "user_id", "item", ORDER, 5, 3, rc.popular(h, "item", 5))


# ---- vectors and graph ---------------------------------------------------------------------------

def _knn_sql(k: int) -> str:
    return f"""SELECT query_id, doc_id, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM
      (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
       FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)) WHERE rank <= {k}"""


def knn_graph(spark, sf, k=5):
    e = load(spark, sf, "embeddings")
    return vx.knn(e, e, k)


@register("knn_embeddings", _knn_sql(10))
def knn_embeddings(spark, sf):
    return knn_graph(spark, sf, 10)


EDGES_SQL = f"""SELECT query_id AS src, TRY_CAST(x AS BIGINT) AS dst FROM (
  SELECT query_id, unnest(string_split(trim(nb), ' ')) AS x FROM (
    SELECT query_id, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY rank) AS nb FROM ({_knn_sql(5)}) GROUP BY query_id))"""


def knn_edges(spark, sf):
    g = knn_graph(spark, sf, 5)
    strings = g.groupBy("query_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))), lambda s: s["doc_id"].cast("string")), " ").alias("neighbors")
    )
    return fx.neighbors(strings, "query_id", "neighbors")


@register("knn_neighbor_edges", EDGES_SQL)
def knn_neighbor_edges(spark, sf):
    return knn_edges(spark, sf)


MEANS_SQL = f"""SELECT ed.src AS node_id, lg.dim, round(avg(CAST(lg.x AS DOUBLE)), 6) AS mean FROM ({EDGES_SQL}) ed JOIN
  (SELECT vec_id AS dst, (i - 1)::BIGINT AS dim, embedding[i] AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)) lg
  ON lg.dst = ed.dst GROUP BY 1, 2"""


@register("neighbor_means", MEANS_SQL)
def neighbor_means(spark, sf):
    nodes = load(spark, sf, "embeddings").select(F.col("vec_id").alias("node_id"), F.col("embedding").alias("features"))
    return gr.neighbor_features(nodes, knn_edges(spark, sf), "node_id", "features")


EVAL = f"{q.bucket(31, 'vec_id')} >= 800000"


@register(
    "index_nodes_embeddings",
    f"SELECT vec_id, CASE WHEN {EVAL} THEN NULL ELSE label END AS label, {EVAL} AS is_eval FROM embeddings",
)
def index_nodes_embeddings(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", "label")
    ev_ = prep.hash_bucket("vec_id", 31) >= 800_000
    return gr.index_nodes(e.filter(~ev_), e.filter(ev_), "vec_id", "label")


def _bin(x):
    return f"least(greatest(floor(({x} + 0.5) / 1.0 * 10), 0), 9)::BIGINT"


NODE_TERMS_SQL = f"""nt AS (
  SELECT vec_id AS row_id, 'o' || CAST(i - 1 AS VARCHAR) || '=' || CAST({_bin('CAST(embedding[i] AS DOUBLE)')} AS VARCHAR) AS term
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
  UNION ALL SELECT node_id, 'n' || CAST(dim AS VARCHAR) || '=' || CAST({_bin('mean')} AS VARCHAR) FROM ({MEANS_SQL})),
ntl AS (SELECT row_id, list(term) AS terms FROM nt GROUP BY row_id)"""

NODE_SQL = f"""WITH {NODE_TERMS_SQL}, {q.nb_ctes(
    f"SELECT e.vec_id AS row_id, CAST(e.label AS VARCHAR) AS label, ntl.terms AS text FROM embeddings e JOIN ntl ON ntl.row_id = e.vec_id WHERE NOT ({EVAL})",
    f"SELECT e.vec_id AS row_id, ntl.terms AS text FROM embeddings e JOIN ntl ON ntl.row_id = e.vec_id WHERE {EVAL}",
    lambda x: x)}"""


def _node_pred(spark, sf):
    e = load(spark, sf, "embeddings")
    ev_ = prep.hash_bucket("vec_id", 31) >= 800_000
    nodes = gr.index_nodes(e.filter(~ev_).select("vec_id", "embedding", "label"), e.filter(ev_).select("vec_id", "embedding", "label"), "vec_id", "label")
    nodes = nodes.select(F.col("vec_id").alias("node_id"), F.col("embedding").alias("features"), "label")
    return gr.classify_nodes(nodes, knn_edges(spark, sf), "node_id", "features", "label", -0.5, 0.5, 10, 1)


@register("classify_nodes_embeddings", f"{NODE_SQL} SELECT row_id AS vec_id, label, score FROM ({q.nb_top(1)})")
def classify_nodes_embeddings(spark, sf):
    return _node_pred(spark, sf).select(F.col("row_id").alias("vec_id"), "label", "score")


@register(
    "node_accuracy",
    f"""{NODE_SQL}, top AS ({q.nb_top(1)})
        SELECT round(avg(CASE WHEN top.label = CAST(e.label AS VARCHAR) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM embeddings e LEFT JOIN top ON top.row_id = e.vec_id WHERE {EVAL}""",
)
def node_accuracy(spark, sf):
    p = _node_pred(spark, sf).select(F.col("row_id").alias("vec_id"), F.col("label").alias("pred"))
    e = load(spark, sf, "embeddings").filter(prep.hash_bucket("vec_id", 31) >= 800_000).select("vec_id", F.col("label").cast("string"))
    return ev.categorical_accuracy(p, e, "vec_id", "pred", "label")


@register(
    "embed_documents",
    f"""WITH fr AS (SELECT doc_id, 1.0 AS w, text FROM documents),
p AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest({q.tok('text')}) AS term FROM fr) GROUP BY 1, 2),
dfs AS (SELECT term, count(*) AS df FROM p GROUP BY term),
st AS (SELECT count(*) AS n FROM documents),
w AS (SELECT p.doc_id, ({q.shash('p.term')} % 64) AS dim,
             CASE WHEN (({q.shash('p.term')} >> 32) % 2) = 0 THEN 1.0 ELSE -1.0 END * p.tf * ln(1 + (st.n - dfs.df + 0.5) / (dfs.df + 0.5)) AS x
      FROM p JOIN dfs ON dfs.term = p.term CROSS JOIN st),
v AS (SELECT doc_id, dim, sum(x) AS x FROM w GROUP BY 1, 2)
SELECT doc_id, dim, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS value FROM v""",
)
def embed_documents(spark, sf):
    return vx.embed_text(ix.build_index(load(spark, sf, "documents"), "doc_id", "text"), 64)


# ---- M6 cold start over pages ----------------------------------------------------------------------

PAGE_FIELDS = f"SELECT doc_id, 3.0 AS w, title AS text FROM ({q.page_docs()}) UNION ALL SELECT doc_id, 1.0 AS w, body AS text FROM ({q.page_docs()})"
TITLE_TERMS = f"SELECT DISTINCT query_id, term, 1.0 AS qw FROM (SELECT doc_id AS query_id, unnest({q.tok('title')}) AS term FROM ({q.page_docs()}))"
COLD_SQL = f"WITH {q.bm25_ctes(PAGE_FIELDS, TITLE_TERMS)} {q.top_k('scores', 5)}"


def _cold(spark, sf):
    pd = html.html_to_corpus(load(spark, sf, "pages"))
    idx = ix.build_index(pd, "doc_id", {"title": ix.W_STRONG, "body": ix.W_WEAK})
    return pd, ix.search(idx, pd.select(F.col("doc_id").alias("query_id"), F.col("title").alias("text")), 5)


@register("cold_start_title_search", COLD_SQL)
def cold_start_title_search(spark, sf):
    return _cold(spark, sf)[1]


@register(
    "cold_start_recall",
    f"""WITH {q.bm25_ctes(PAGE_FIELDS, TITLE_TERMS)}, h AS ({q.top_k('scores', 5)}), pdx AS ({q.page_docs()}),
        tr AS (SELECT DISTINCT a.doc_id AS query_id, b.doc_id FROM pdx a JOIN pdx b ON a.title = b.title),
        per_q AS (SELECT tr.query_id, avg(CASE WHEN h.doc_id IS NULL THEN 0.0 ELSE 1.0 END) AS r
                  FROM tr LEFT JOIN h ON h.query_id = tr.query_id AND h.doc_id = tr.doc_id GROUP BY tr.query_id)
        SELECT round(avg(r), 6) AS recall_at_k FROM per_q""",
)
def cold_start_recall(spark, sf):
    pd, hits = _cold(spark, sf)
    a, b = pd.select(F.col("doc_id").alias("query_id"), "title"), pd.select("doc_id", "title")
    truth = a.join(b, "title").select("query_id", "doc_id")
    return ev.recall_at_k(hits, truth, 5)


def _grams(x):
    return f"list_distinct(CASE WHEN length({x}) <= 3 THEN [{x}] ELSE list_transform(range(1, length({x}) - 1), lambda i: substring({x}, i, 3)) END)"


def _cold_ids_sql():
    train = f"SELECT row_number() OVER () AS row_id, CAST(doc_id AS VARCHAR) AS label, query AS text FROM ({ORACLES['cold_start_pages']})"
    return f"""WITH {q.nb_ctes(train, f"SELECT doc_id AS row_id, title AS text FROM ({q.page_docs()})")}
        SELECT row_id AS doc_id, label AS id, score, prob, rank FROM ({q.nb_top(3)})"""


@register("cold_start_ids", _cold_ids_sql())
def cold_start_ids(spark, sf):
    """M6: every page's title finds the ids of the pages that its words speak for."""
    pd = html.html_to_corpus(load(spark, sf, "pages"))
    hits = cl.predict(cl.cold_start(pd, "doc_id", "title", "body"), pd, "doc_id", "title", 3)
    return hits.select(F.col("row_id").alias("doc_id"), F.col("label").alias("id"), "score", "prob", "rank")


# ---- M17 reformulation ---------------------------------------------------------------------------------

# DuckDB's edit distance counts bytes: characters beyond ASCII are first put in place of control characters,
# which titles do not hold.
_CONTROLS = " || ".join(f"chr({i})" for i in (*range(1, 9), 11, 12, *range(14, 32), 127))
_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
REFORM_SQL = f"""WITH nz AS ({_noisy_sql()}), q AS (SELECT doc_id * 2 + copy AS query_id, noisy AS query, source FROM nz),
t AS (SELECT DISTINCT title AS target FROM ({q.page_docs()})),
al AS (SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS s FROM (SELECT DISTINCT unnest(string_split(target, '')) AS ch FROM t) WHERE unicode(ch) > 127),
qs AS (SELECT DISTINCT query FROM q),
qg AS (SELECT query, unnest({_grams(_AZ.format('query'))}) AS g FROM qs), tg AS (SELECT target, unnest({_grams(_AZ.format('target'))}) AS g FROM t),
cand AS (SELECT DISTINCT query, target FROM qg JOIN tg USING (g)),
d AS (SELECT query, target, levenshtein(translate(query, s, {_CONTROLS}), translate(target, s, {_CONTROLS})) AS distance FROM cand CROSS JOIN al),
best AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, target) AS rank FROM d),
hits AS (SELECT q.query_id, best.target, best.rank, best.distance, 0::BIGINT AS learned FROM q JOIN best USING (query) WHERE best.rank <= 3)"""


def _reform(spark, sf, k=3):
    pd = html.html_to_corpus(load(spark, sf, "pages"))
    noisy = prep.noisy_queries(pd, "title", "doc_id", copies=2).select(
        (F.col("doc_id") * 2 + F.col("copy")).alias("query_id"), F.col("noisy").alias("query"), F.col("source")
    )
    return noisy, rf.reformulate(pd.select(F.col("title").alias("target")), noisy, k)


@register("reformulate_titles", f"{REFORM_SQL} SELECT query_id, target, rank, distance, learned FROM hits")
def reformulate_titles(spark, sf):
    return _reform(spark, sf)[1]


@register(
    "reformulate_recall",
    f"""{REFORM_SQL} SELECT round(avg(r), 6) AS recall_at_k FROM (
        SELECT q.query_id, avg(CASE WHEN hits.target IS NULL THEN 0.0 ELSE 1.0 END) AS r
        FROM q LEFT JOIN hits ON hits.query_id = q.query_id AND hits.target = q.source GROUP BY q.query_id)""",
)
def reformulate_recall(spark, sf):
    noisy, hits = _reform(spark, sf)
    truth = noisy.select("query_id", F.col("source").alias("doc_id"))
    return ev.recall_at_k(hits.select("query_id", F.col("target").alias("doc_id"), "rank"), truth, 3)


# ---- D15: neighbours by sign codes, measured against D14 --------------------------------------------

# The same planes from the stable hash.  One bucket: all codes are looked at below two buckets' worth of vectors.
_APPROX_SQL = f"""WITH pl AS (SELECT b AS bit, list(CASE WHEN {q.shash("'7:' || b || ':' || d")} % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE ORDER BY d) AS signs
  FROM range(256) t(b), range((SELECT max(len(embedding)) FROM embeddings)) u(d) GROUP BY b),
e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
c AS (SELECT vec_id, string_agg(CASE WHEN list_dot_product(v, signs) >= 0 THEN '1' ELSE '0' END, '' ORDER BY bit)::BIT AS code FROM e, pl GROUP BY vec_id),
f AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, bit_count(xor(a.code, b.code)) AS far FROM c a JOIN c b ON a.vec_id <> b.vec_id),
s AS (SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY far, doc_id) AS r FROM f) WHERE r <= 200),
x AS (SELECT s.query_id, s.doc_id, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM s JOIN e a ON a.vec_id = s.query_id JOIN e b ON b.vec_id = s.doc_id)
SELECT query_id, doc_id, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM x) WHERE rank <= 10"""


@register("knn_approx_embeddings", _APPROX_SQL)
def knn_approx_embeddings(spark, sf):
    e = load(spark, sf, "embeddings")
    return vx.knn_approx(e, e, 10)


@register(
    "knn_approx_recall",
    f"""SELECT round(avg(r), 6) AS recall_at_k FROM (
        SELECT t.query_id, avg(CASE WHEN h.doc_id IS NULL THEN 0.0 ELSE 1.0 END) AS r
        FROM ({_knn_sql(10)}) t LEFT JOIN ({_APPROX_SQL}) h ON h.query_id = t.query_id AND h.doc_id = t.doc_id GROUP BY t.query_id)""",
)
def knn_approx_recall(spark, sf):
    """Share of the exact top 10 (D14) that the codes' short list holds."""
    e = load(spark, sf, "embeddings")
    exact = vx.knn(e, e, 10)
    approx = vx.knn_approx(e, e, 10)
    return ev.recall_at_k(approx, exact.select("query_id", "doc_id"), 10)
