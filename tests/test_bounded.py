"""Bounded scoring gives the top k of scoring every pair."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import bounded
from corpusmill.operators import feedback as fb
from corpusmill.operators import index as ix
from corpusmill.operators.topk import top_k_by_score
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def index(spark):
    return ix.build_index(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text")


def random_block(rng, n_docs, n_terms):
    pairs = sorted({(rng.randrange(n_docs), min(int(rng.expovariate(0.05)), n_terms - 1)) for _ in range(n_docs * 30)}, key=lambda p: p[1])
    doc, code = (np.array(c) for c in zip(*pairs))
    return doc * 7 - 50, code, np.array([rng.choice([0.5, 1.0, 1.7, 2.2]) for _ in pairs])


@pytest.mark.parametrize("seed", range(6))
def test_block_matches_brute_force(seed):
    rng = random.Random(seed)
    n_terms = 120
    ids, code, sat = random_block(rng, rng.choice([5, 60, 900]), n_terms)
    code = np.unique(code, return_inverse=True)[1]
    block = bounded.Block(ids, code, sat, code.max() + 1)
    work = bounded.Work()
    for _ in range(40):
        terms = np.array(rng.sample(range(code.max() + 1), min(rng.randint(1, 60), code.max() + 1)))
        weights = np.array([rng.choice([0.1, 0.3, 1.0, 4.0, 8.0]) for _ in terms])
        k, exclude = rng.choice([1, 3, 10]), rng.choice([None, int(ids[0]), 10**9])
        got, score = block.best(terms, weights, k, exclude, work)
        total = {}
        for i, c, s in zip(ids, code, sat):
            for t, w in zip(terms, weights):
                if c == t and i != exclude:
                    total[int(i)] = total.get(int(i), 0.0) + w * s
        want = sorted(total.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k]
        assert got.tolist() == [i for i, _ in want]
        assert np.allclose(score, [s for _, s in want])
    assert work.scored <= 2 * work.postings


def test_frequent_terms_reach_only_documents_that_can_win():
    """One rare term decides; the frequent ones are looked up for few documents."""
    n = 5000
    ids = np.concatenate([np.arange(n)] * 3 + [np.arange(20)])
    code = np.repeat([0, 1, 2, 3], [n, n, n, 20])
    block = bounded.Block(ids, code, np.ones(len(ids)), 4)
    work = bounded.Work()
    got, _ = block.best(np.arange(4), np.array([0.1, 0.1, 0.1, 9.0]), 5, None, work)
    assert got.tolist() == [0, 1, 2, 3, 4] and work.postings == 3 * n + 20 and work.scored < 500


def every_pair(index, qterms, k, same=True):
    scores = ix.score_terms(index, qterms)
    if not same:
        scores = scores.where("query_id <> doc_id")
    return top_k_by_score(scores, "query_id", "score", "doc_id", k).select("query_id", "doc_id", "rank", "score")


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_queries_match_scoring_every_pair(spark, index, monkeypatch):
    qterms = ix.doc_top_terms(index).select(F.col("doc_id").alias("query_id"), "term")
    want = table(every_pair(index, qterms, 4, same=False))
    assert table(ix.similar_docs(index, None, 4)) == want
    monkeypatch.setattr(bounded, "BLOCK", 3000)  # many blocks of documents and of queries
    assert table(ix.similar_docs(index, None, 4)) == want
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    want = table(every_pair(index, ix.query_terms(bench), 3))
    assert table(ix.search(index, bench, 3)) == want == table(ix.search_sharded(index, bench, 3, 3))


def test_search_of_nothing(spark, index):
    none = spark.createDataFrame([(1, "zzzzqq zzzqqq"), (2, ""), (3, None)], "query_id long, text string")
    assert ix.search(index, none, 3).count() == 0 and ix.search(index, none.limit(0), 3).count() == 0
    empty = ix.build_index(spark.createDataFrame([], "doc_id long, text string"))
    assert ix.search(empty, none, 3).count() == 0


def test_upvotes_enter_without_a_shared_word(spark, index):
    """Boosts against a full join over all scores."""
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    ids = [r[0] for r in index.doc_len.select("doc_id").limit(6).collect()]
    ups = bench.withColumn("doc_id", F.element_at(F.array(*[F.lit(i) for i in ids]), (F.col("query_id") % 6 + 1).cast("int")))
    boosts = fb.upvote_table(ups.select(F.col("text").alias("query"), "doc_id"))
    scores = ix.score_terms(index, ix.query_terms(bench))
    qb = bench.select("query_id", fb.query_key("text").alias("key")).join(boosts, "key").select("query_id", "doc_id", "boost")
    merged = scores.join(qb, ["query_id", "doc_id"], "full_outer").select(
        "query_id", "doc_id", F.round(F.coalesce("score", F.lit(0.0)) + F.coalesce("boost", F.lit(0.0)), 6).alias("score"))
    want = top_k_by_score(merged, "query_id", "score", "doc_id", 3).select("query_id", "doc_id", "rank", "score")
    assert table(fb.search_with_upvotes(index, bench, boosts, 3)) == table(want)


def test_queries_pass_a_block_in_parts(monkeypatch):
    """Rows of two groups in small batches: the answers are those of each whole query, and no more
    query rows are held than one part and one query."""
    rng = np.random.default_rng(3)
    words = np.array([f"t{i}" for i in range(40)])
    rows, want = [], set()
    for grp in (4, 7):  # a group without postings after them
        doc, term = np.repeat(np.arange(30), 8), np.concatenate([rng.choice(40, 8, replace=False) for _ in range(30)])
        sat = rng.random(len(doc)).round(3)
        rows += [(grp, False, int(d), str(words[t]), float(s)) for d, t, s in zip(doc, term, sat)]
        for q in range(50):
            terms, weights = rng.choice(40, 6, replace=False), rng.random(6).round(3)
            rows += [(grp, True, q, str(words[t]), float(w)) for t, w in zip(terms, weights)] + [(grp, True, q, "unknown", 1.0)]
            score = {}
            for d, t, s in zip(doc, term, sat):
                for t2, w in zip(terms, weights):
                    if t == t2:
                        score[int(d)] = score.get(int(d), 0.0) + w * s
            want |= {(q, d, round(s, 6), grp // 2) for d, s in sorted(score.items(), key=lambda x: (-round(x[1], 6), x[0]))[:3]}
    rows += [(9, True, 1, "t1", 1.0)]
    table_ = pa.table(dict(zip(["grp", "is_query", "id", "term", "v"], map(list, zip(*rows)))))
    monkeypatch.setattr(bounded, "QUERY_ROWS", 20)
    held, answers = [], bounded._Group.answers

    def watched(self, last):
        held.append(sum(t.num_rows for t in self.queries))
        yield from answers(self, last)

    monkeypatch.setattr(bounded._Group, "answers", watched)
    got = [r for b in bounded._scored(3, False, 2)(iter(table_.to_batches(max_chunksize=11))) for r in b.to_pylist()]
    assert {(r["query_id"], r["doc_id"], round(r["raw"], 6), r["dblk"]) for r in got} == want and len(got) == len(want)
    assert len(held) > 20 and max(held) <= 20 + 11


def test_blocks_stay_bounded_and_few_rows_are_sent_twice():
    for postings, terms, tasks in ((180_000_000, 4_000_000, 200), (3_000_000, 64_000, 24), (120_000_000, 120_000_000, 200), (10, 10**9, 8), (0, 0, 8)):
        nd, nq = bounded._grid(postings, terms, tasks)
        assert nd >= 1 and nq >= 1 and -(-postings // nd) <= bounded.BLOCK and nq <= tasks
        assert nd == 1 or nd * nq <= max(tasks, 2 * -(-postings // bounded.BLOCK))


def test_another_order_is_refused():
    part = lambda *rows: pa.table({"id": [r[0] for r in rows], "term": ["t"] * len(rows), "v": [1.0] * len(rows)})
    group = bounded._Group(2, False)
    list(group.met(False, part((1,))))
    list(group.met(True, part((5,), (4,))))
    with pytest.raises(ValueError):
        list(group.met(False, part((2,))))
    with pytest.raises(ValueError):
        list(group.answers(True))
