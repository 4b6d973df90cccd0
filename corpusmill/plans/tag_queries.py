"""Personal data and token tagging (N1-N7, F10, E6, D13) on the driver tables.

Tag data is derived from ``documents``: every whitespace token gets a silver
kind (EMAIL when it holds an e-mail address, NUM when it holds a digit, else
O) in B-/I- form, which is what the tagger learns and is scored against."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from corpusmill.functions.pii import RULES
from corpusmill.operators import evaluate as ev
from corpusmill.operators import feedback as fb
from corpusmill.operators import features as fx
from corpusmill.operators import index as ix
from corpusmill.operators import prep
from corpusmill.operators import tagging as tg
from corpusmill.plans import sql as q
from corpusmill.plans.registry import load, register
from corpusmill.plans.search_queries import BENCH_TERMS, DOC_FIELDS, K, bench_queries, doc_index
from corpusmill.session import ensure_checkpoint_dir, spread
from corpusmill.sources import store

EMAIL_RE = RULES[0][1]
N_RULES = len(RULES)


def gazetteer(spark, sf):
    n = load(spark, sf, "nation").select(F.col("n_name").alias("name"))
    r = load(spark, sf, "region").select(F.col("r_name").alias("name"))
    return n.unionByName(r)


FINDS_SQL = f"""WITH {q.pii_chain('SELECT doc_id, text FROM documents')},
fx AS (SELECT doc_id, {' || '.join(f"list_transform(f{i}, lambda v: {{'kind': '{k}', 'value': v}})" for i, (k, _, _) in enumerate(RULES))} AS fs FROM pm),
pat AS (SELECT doc_id, f.kind AS kind, f.value AS value FROM (SELECT doc_id, unnest(fs) AS f FROM fx)),
gz AS (SELECT n_name AS value FROM nation UNION SELECT r_name FROM region),
loc AS (SELECT w.doc_id, 'LOCATION' AS kind, w.value FROM
        (SELECT doc_id, array_to_string(w[i : i + n - 1], ' ') AS value FROM
          (SELECT doc_id, string_split(unnest(regexp_extract_all(masked, '[\\p{{L}}\\p{{N}}_]+(?: [\\p{{L}}\\p{{N}}_]+)*', 0)), ' ') AS w FROM pm) r,
          (SELECT DISTINCT len(string_split(value, ' ')) AS n FROM gz) sz, unnest(range(1, len(w) - n + 2)) AS u(i)) w
        JOIN gz ON gz.value = w.value)
SELECT * FROM pat UNION ALL SELECT * FROM loc"""


@register("pii_finds", FINDS_SQL)
def pii_finds(spark, sf):
    return tg.detect_pii(load(spark, sf, "documents"), "doc_id", "text", gazetteer(spark, sf))


@register("pii_counts", f"WITH f AS ({FINDS_SQL}) SELECT kind, count(*) AS n FROM f GROUP BY kind")
def pii_counts(spark, sf):
    return pii_finds(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@register("redact_documents", f"WITH {q.pii_chain('SELECT doc_id, text FROM documents')} SELECT doc_id, masked AS text FROM pm")
def redact_documents(spark, sf):
    return tg.redact(load(spark, sf, "documents").select("doc_id", "text"))


@register(
    "redact_conversations",
    f"""WITH {q.pii_chain("SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS k, text FROM conversations", 'k')}
        SELECT k, masked AS text FROM pm""",
)
def redact_conversations(spark, sf):
    c = load(spark, sf, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("k"), "text")
    return tg.redact(c, "k", "text")


@register(
    "rag_context_redacted",
    f"""WITH {q.bm25_ctes(DOC_FIELDS, BENCH_TERMS)}, h AS ({q.top_k('scores', K)}),
{q.pii_chain('SELECT doc_id, text FROM documents')},
ctx AS (SELECT h.query_id, string_agg(pm.masked, chr(10) || chr(10) ORDER BY h.rank) AS context
        FROM h JOIN pm ON pm.doc_id = h.doc_id WHERE h.rank <= 3 GROUP BY h.query_id)
SELECT b.item_id AS query_id,
       'Answer the following question in about 50 words using the context given: ' || chr(10) || 'Question : ' || b.text || ' ' || chr(10)
       || 'Context: ' || coalesce(ctx.context, '') AS prompt
FROM benchmark b LEFT JOIN ctx ON ctx.query_id = b.item_id""",
)
def rag_context_redacted(spark, sf):
    hits = ix.search(doc_index(spark, sf), bench_queries(spark, sf), K).persist(StorageLevel.MEMORY_AND_DISK)
    used = hits.filter("rank <= 3").select("doc_id").distinct()  # only these texts run through the rules
    texts = tg.redact(load(spark, sf, "documents").select("doc_id", "text").join(used, "doc_id", "left_semi"))
    return fb.rag_context(hits, texts, bench_queries(spark, sf), 3)


# ---- silver tags, alignment, tagger ------------------------------------------------------------

def silver(spark, sf):
    d = spread(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    ws = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    # The e-mail pattern only runs on tokens holding an "@".
    kinds = F.transform(ws, lambda t: F.when(t.contains("@") & t.rlike(EMAIL_RE), "EMAIL").when(t.rlike("[0-9]"), "NUM").otherwise("O"))
    d = d.withColumn("_k", kinds)
    bio = F.transform(
        "_k",
        lambda k, i: F.when(k == "O", "O")
        .when((i > 0) & (F.element_at(F.col("_k"), F.greatest(i, F.lit(1))) == k), F.concat(F.lit("I-"), k))
        .otherwise(F.concat(F.lit("B-"), k)),
    )
    return d.select("doc_id", "text", F.array_join(bio, " ").alias("tags"))


TAGS = ["B-EMAIL", "I-EMAIL", "B-NUM", "I-NUM"]

SILVER_SQL = f"""al AS (
  SELECT doc_id, ws, list_transform(kinds, lambda k, i: CASE WHEN k = 'O' THEN 'O' WHEN i > 1 AND kinds[i - 1] = k THEN 'I-' || k ELSE 'B-' || k END) AS tags
  FROM (SELECT doc_id, ws, list_transform(ws, lambda t: CASE WHEN regexp_matches(t, '{EMAIL_RE}') THEN 'EMAIL'
                                                         WHEN regexp_matches(t, '[0-9]') THEN 'NUM' ELSE 'O' END) AS kinds
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws FROM documents))),
rw AS (SELECT doc_id, (i - 1)::BIGINT AS pos, ws[i] AS token, tags[i] AS tag FROM (SELECT doc_id, ws, tags, unnest(range(1, len(ws) + 1)) AS i FROM al))"""


def aligned(spark, sf):
    good, _bad = fx.align_tags(silver(spark, sf), "doc_id", "text", "tags", TAGS, "O")
    return good


@register("align_tags_documents", f"WITH {SILVER_SQL} SELECT doc_id, pos, token, tag FROM rw")
def align_tags_documents(spark, sf):
    return aligned(spark, sf)


TRAIN = f"{q.bucket(23, 'doc_id')} < 800000"


def _train_rows(spark, sf):
    # Split documents before aligning, so the hash is taken once per document, not per token.
    s = silver(spark, sf).withColumn("_train", prep.hash_bucket("doc_id", 23) < 800_000)
    # Training reads its part once and tagging the other: tokens are not kept.
    good, _bad = fx.align_tags(s, "doc_id", "text", "tags", TAGS, "O", keep=["_train"], previous=True)
    return good.filter("_train").drop("_train"), good.filter(~F.col("_train")).drop("_train")


@register("tagger_word_counts", f"WITH {SILVER_SQL} SELECT lower(token) AS token, tag, count(*)::DOUBLE AS n FROM rw WHERE {TRAIN} GROUP BY 1, 2")
def tagger_word_counts(spark, sf):
    tr, _ = _train_rows(spark, sf)
    return tg.fit_tagger(tr, "doc_id").word_tag


TRANS_SQL = f"""WITH {SILVER_SQL}, t AS (SELECT * FROM rw WHERE {TRAIN})
SELECT coalesce(p.tag, '<s>') AS prev_tag, t.tag, count(*)::DOUBLE AS n FROM t LEFT JOIN t p ON p.doc_id = t.doc_id AND p.pos = t.pos - 1 GROUP BY 1, 2"""


@register("tagger_transitions", TRANS_SQL)
def tagger_transitions(spark, sf):
    tr, _ = _train_rows(spark, sf)
    return tg.fit_tagger(tr, "doc_id").trans


@register("tagger_saved_transitions", TRANS_SQL)
def tagger_saved_transitions(spark, sf):
    """Train, store, reload."""
    tr, _ = _train_rows(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    store.save_model(tg.fit_tagger(tr, "doc_id"), path)
    return store.load_model(spark, path, tg.TaggerModel).trans


@register("tagger_fine_tuned_transitions", TRANS_SQL)
def tagger_fine_tuned_transitions(spark, sf):
    """Fit on part of the rows, fine-tune on the rest = joint fit."""
    tr, _ = _train_rows(spark, sf)
    half = prep.hash_bucket("doc_id", 29) < 500_000
    m = tg.fit_tagger(tr.filter(half), "doc_id")
    return tg.fine_tune_tagger(m, tr.filter(~half), "doc_id").trans


def tag_shape(x):
    s = f"regexp_replace(regexp_replace(regexp_replace({x}, '\\p{{Lu}}', 'X', 'g'), '\\p{{Ll}}', 'x', 'g'), '[0-9]', 'd', 'g')"
    return f"regexp_replace(regexp_replace(regexp_replace({s}, 'X+', 'X', 'g'), 'x+', 'x', 'g'), 'd+', 'd', 'g')"


TAGGER_SQL = f"""WITH {SILVER_SQL},
tr AS (SELECT * FROM rw WHERE {TRAIN}), te AS (SELECT * FROM rw WHERE NOT ({TRAIN})),
tgc AS (SELECT tag, count(*)::DOUBLE AS tn FROM tr GROUP BY tag),
wt AS (SELECT lower(token) AS token, tag, count(*)::DOUBLE AS nw FROM tr GROUP BY 1, 2),
sh AS (SELECT {tag_shape('token')} AS shape, tag, count(*)::DOUBLE AS ns FROM tr GROUP BY 1, 2),
cst AS (SELECT (SELECT count(DISTINCT token) FROM wt)::DOUBLE AS vw, (SELECT count(DISTINCT shape) FROM sh)::DOUBLE AS vs,
               (SELECT sum(tn) FROM tgc) AS tot)"""

TAG_SQL = f"""{TAGGER_SQL},
cand AS (SELECT te.doc_id, te.pos, lower(te.token) AS token, {tag_shape('te.token')} AS shape, tgc.tag, tgc.tn FROM te CROSS JOIN tgc),
sc AS (SELECT c.doc_id, c.pos, c.tag, round(ln(c.tn / cst.tot) + ln((coalesce(wt.nw, 0) + 1) / (c.tn + cst.vw))
                                          + ln((coalesce(sh.ns, 0) + 1) / (c.tn + cst.vs)), 4) AS score
       FROM cand c CROSS JOIN cst LEFT JOIN wt ON wt.token = c.token AND wt.tag = c.tag LEFT JOIN sh ON sh.shape = c.shape AND sh.tag = c.tag),
top AS (SELECT doc_id, pos, tag, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY score DESC, tag) AS r FROM sc) WHERE r = 1)"""


def tagger_model(spark, sf):
    return tg.fit_tagger(_train_rows(spark, sf)[0], "doc_id")


def _tagged(spark, sf):
    tr, te = _train_rows(spark, sf)
    m = tg.fit_tagger(tr, "doc_id")
    return tg.tag(m, te.select(F.col("doc_id").alias("row_id"), "pos", "token"), 1), te


@register("tag_tokens", f"{TAG_SQL} SELECT doc_id, pos, tag, score FROM top")
def tag_tokens(spark, sf):
    p, _ = _tagged(spark, sf)
    return p.select(F.col("row_id").alias("doc_id"), "pos", "tag", "score")


@register(
    "tag_token_accuracy",
    f"""{TAG_SQL} SELECT round(avg(CASE WHEN top.tag = te.tag THEN 1.0 ELSE 0.0 END), 6) AS token_accuracy
        FROM te LEFT JOIN top ON top.doc_id = te.doc_id AND top.pos = te.pos""",
)
def tag_token_accuracy(spark, sf):
    p, te = _tagged(spark, sf)
    return ev.token_accuracy(p.withColumnRenamed("row_id", "doc_id"), te, ["doc_id", "pos"])


@register(
    "bio_spans_documents",
    f"""WITH {SILVER_SQL},
w AS (SELECT doc_id, pos, tag, lag(tag) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM rw),
s AS (SELECT *, CASE WHEN tag <> 'O' AND (starts_with(tag, 'B-') OR coalesce(prev, 'O') = 'O'
                     OR regexp_replace(coalesce(prev, 'O'), '^[BI]-', '') <> regexp_replace(tag, '^[BI]-', '')) THEN 1 ELSE 0 END AS st FROM w),
g AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM s)
SELECT doc_id, first(regexp_replace(tag, '^[BI]-', '') ORDER BY pos) AS kind, min(pos) AS start, max(pos) AS "end"
FROM g WHERE tag <> 'O' GROUP BY doc_id, span""",
)
def bio_spans_documents(spark, sf):
    return tg.bio_spans(aligned(spark, sf).withColumnRenamed("doc_id", "row_id"), "row_id").withColumnRenamed("row_id", "doc_id")


@register(
    "sentences_documents",
    f"""SELECT doc_id, (i - 1)::BIGINT AS sent_no, s[i] AS sentence FROM
        (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {q.sentences('text')} AS s FROM documents))""",
)
def sentences_documents(spark, sf):
    return tg.sentence_rows(load(spark, sf, "documents"))


@register(
    "extraction_stats",
    f"SELECT source, count(*) AS n_docs, sum(len({q.sentences('text')}))::BIGINT AS n_sentences FROM documents GROUP BY source",
)
def extraction_stats(spark, sf):
    return tg.extraction_stats(load(spark, sf, "documents"))


@register("tag_tokens_decoded")
def tag_tokens_decoded(spark, sf):
    """N4 with sequence decoding (rows-only: the decode runs in numpy per document)."""
    tr, te = _train_rows(spark, sf)
    m = tg.fit_tagger(tr, "doc_id")
    return tg.decode(m, te.select(F.col("doc_id").alias("row_id"), "pos", "token")).withColumnRenamed("row_id", "doc_id")


@register("tag_decoded_accuracy")
def tag_decoded_accuracy(spark, sf):
    tr, te = _train_rows(spark, sf)
    m = tg.fit_tagger(tr, "doc_id")
    d = tg.decode(m, te.select(F.col("doc_id").alias("row_id"), "pos", "token")).withColumnRenamed("row_id", "doc_id")
    return ev.token_accuracy(d, te, ["doc_id", "pos"])
