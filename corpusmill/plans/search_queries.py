"""Search queries (D1-D5, D9-D11) and their metrics (E2, E3) on the driver tables.

Flagship: every ``benchmark`` item is a query over ``documents``; the truth for
an item is every document containing its whole text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import evaluate as ev
from corpusmill.operators import index as ix
from corpusmill.plans import sql as q
from corpusmill.plans.registry import load, register
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources import store

K = 5

DOC_FIELDS = "SELECT doc_id, 1.0 AS w, text FROM documents"
BENCH_TERMS = q.distinct_terms("benchmark", "item_id", "text")
BM25_SQL = f"WITH {q.bm25_ctes(DOC_FIELDS, BENCH_TERMS)} {q.top_k('scores', K)}"

TRUTH_SQL = "SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"


def doc_index(spark, sf):
    return ix.build_index(load(spark, sf, "documents"), "doc_id", "text")


def bench_queries(spark, sf):
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@register("bm25_search", BM25_SQL)
def bm25_search(spark, sf):
    return ix.search(doc_index(spark, sf), bench_queries(spark, sf), K)


@register("save_load_search", BM25_SQL)
def save_load_search(spark, sf):
    """Index stored and reloaded."""
    path = f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"
    store.save_index(doc_index(spark, sf), path)
    return ix.search(store.load_index(spark, path), bench_queries(spark, sf), K)


@register("resumable_build", BM25_SQL)
def resumable_build(spark, sf):
    """A build that stops after three of eight buckets is taken up again."""
    path = f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"
    docs = load(spark, sf, "documents")
    store.build_resumable(docs, path, stop_after=3)
    return ix.search(store.build_resumable(docs, path), bench_queries(spark, sf), K)


@register(
    "index_postings",
    f"""SELECT doc_id, term, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest({q.tok('text')}) AS term FROM documents)
        GROUP BY doc_id, term""",
)
def index_postings(spark, sf):
    return doc_index(spark, sf).postings.select("doc_id", "term", "tf")


@register(
    "index_term_stats",
    f"""SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({q.tok('text')}) AS term FROM documents)
        GROUP BY term""",
)
def index_term_stats(spark, sf):
    return doc_index(spark, sf).term_stats


@register(
    "index_doc_len",
    f"SELECT doc_id, len({q.tok('text')})::DOUBLE AS dl FROM documents",
)
def index_doc_len(spark, sf):
    return doc_index(spark, sf).doc_len


@register(
    "fetch_hits",
    f"""WITH {q.bm25_ctes(DOC_FIELDS, BENCH_TERMS)}, h AS ({q.top_k('scores', K)})
        SELECT h.query_id, h.rank, h.doc_id, h.score, d.source, d.lang, d.n_chars
        FROM h JOIN documents d ON d.doc_id = h.doc_id""",
)
def fetch_hits(spark, sf):
    hits = bm25_search(spark, sf)
    return ix.fetch(hits, load(spark, sf, "documents"), ["source", "lang", "n_chars"]).select(
        "query_id", "rank", "doc_id", "score", "source", "lang", "n_chars"
    )


@register("containment_truth", TRUTH_SQL)
def containment_truth(spark, sf, idx=None):
    docs = load(spark, sf, "documents")
    idx = idx or ix.build_index(docs, "doc_id", "text")
    return ix.containing_docs(idx, docs, load(spark, sf, "benchmark")).select(F.col("item_id").alias("query_id"), "doc_id")


@register(
    "search_precision_at_1",
    f"""WITH {q.bm25_ctes(DOC_FIELDS, BENCH_TERMS)}, h AS ({q.top_k('scores', K)}), tr AS ({TRUTH_SQL}),
        tq AS (SELECT DISTINCT query_id FROM tr),
        ok AS (SELECT DISTINCT h.query_id FROM h JOIN tr ON h.query_id = tr.query_id AND h.doc_id = tr.doc_id WHERE h.rank = 1)
        SELECT round(avg(CASE WHEN ok.query_id IS NULL THEN 0.0 ELSE 1.0 END), 6) AS precision_at_1
        FROM tq LEFT JOIN ok ON tq.query_id = ok.query_id""",
)
def search_precision_at_1(spark, sf):
    idx = doc_index(spark, sf)
    return ev.precision_at_1(ix.search(idx, bench_queries(spark, sf), K), containment_truth(spark, sf, idx))


@register(
    "search_recall_at_5",
    f"""WITH {q.bm25_ctes(DOC_FIELDS, BENCH_TERMS)}, h AS ({q.top_k('scores', K)}), tr AS ({TRUTH_SQL}),
        per_q AS (SELECT tr.query_id, avg(CASE WHEN h.doc_id IS NULL THEN 0.0 ELSE 1.0 END) AS r
                  FROM tr LEFT JOIN h ON h.query_id = tr.query_id AND h.doc_id = tr.doc_id GROUP BY tr.query_id)
        SELECT round(avg(r), 6) AS recall_at_k FROM per_q""",
)
def search_recall_at_5(spark, sf):
    idx = doc_index(spark, sf)
    return ev.recall_at_k(ix.search(idx, bench_queries(spark, sf), K), containment_truth(spark, sf, idx), K)
