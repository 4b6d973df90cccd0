"""Every document against all others: crossed blocks give the top k of scoring every pair, and write no more for more blocks."""

import random

import numpy as np
import pytest

from corpusmill.operators import bounded, crossed
from corpusmill.operators import index as ix
from corpusmill.operators.topk import top_k_by_score
from tests.conftest import SMALL


def random_rows(rng, ids, n_terms):
    """Some terms that nearly all documents have, many that few have, and copies."""
    rows = []
    for i in ids:
        if rows and rng.random() < 0.2:
            other = rng.choice(rows)[0]
            rows += [(i, c, v) for d, c, v in rows if d == other]
        else:
            own = {int(n_terms * rng.random() ** 3) for _ in range(rng.randint(1, 25))}
            rows += [(i, c * 31 - 500, rng.choice([0.25, 0.5, 1.5, 2.0])) for c in own]
    return rows


def block(rows):
    return crossed.block_of(*map(np.array, zip(*rows)))


@pytest.mark.parametrize("seed", range(6))
def test_blocks_match_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(crossed, "STEP", 50)
    ids = rng.sample(range(-100, 900), 90)
    rows = random_rows(rng, ids, rng.choice([3, 40, 400]))
    k, parts = rng.choice([1, 3, 10]), [ids[:30], ids[30:31], ids[31:]]
    blocks = [block([r for r in rows if r[0] in part]) for part in parts]
    total = {}
    for q, c, _ in rows:
        for d, c2, v in rows:
            if c == c2 and q != d:
                total.setdefault(q, {}).setdefault(d, 0.0)
                total[q][d] += v
    for queries in blocks:
        best = crossed.Best(queries.ids, k)
        for docs in blocks:
            best.met(docs.ids, crossed.pair_scores(crossed.Block(queries.ids, queries.code, queries.edge, queries.doc), docs))
        got = list(zip(queries.ids[best.row].tolist(), best.doc.tolist(), best.score.tolist()))
        want = [(q, d, s) for q in queries.ids.tolist() for d, s in sorted(total.get(q, {}).items(), key=lambda x: (-x[1], x[0]))[:k]]
        assert got == want


def test_blocks_without_a_shared_term():
    a, b = block([(1, 5, 1.0), (2, 6, 1.0)]), block([(3, 7, 1.0)])
    best = crossed.Best(a.ids, 2)
    best.met(b.ids, crossed.pair_scores(a, b))
    assert len(best.row) == 0


def shuffled(spark, df):
    """The rows of ``df``, and the bytes of shuffle files that working them out wrote."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every = manager.getAllFiles()
        return {f.getName(): f.length() for f in (every.apply(i) for i in range(every.length())) if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    before = files()
    rows = sorted(tuple(r) for r in df().collect())
    return rows, sum(size for name, size in files().items() if name not in before)


def test_more_blocks_write_no_more(spark, monkeypatch):
    index = ix.build_index(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text")
    n = index.postings.count()
    rows, few = shuffled(spark, lambda: ix.similar_docs(index, None, 5))
    monkeypatch.setattr(bounded, "BLOCK", n // 30)
    again, many = shuffled(spark, lambda: ix.similar_docs(index, None, 5))
    assert again == rows and few > 0 and many < 3 * few
    qterms = ix.doc_top_terms(index).selectExpr("doc_id AS query_id", "term")
    want = top_k_by_score(ix.score_terms(index, qterms).where("query_id <> doc_id"), "query_id", "score", "doc_id", 5)
    assert rows == sorted(tuple(r) for r in want.select("query_id", "doc_id", "rank", "score").collect())


def test_similar_documents_of_few(spark):
    docs = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = lambda d: sorted(tuple(r)[:3] for r in ix.similar_docs(ix.build_index(d), None, 2).collect())
    assert found(docs()) == found(docs("", None)) == found(docs("one")) == found(docs("one", "two")) == []
    assert found(docs("a b", "", "b c", "a b", None, "x")) == [(0, 2, 2), (0, 3, 1), (2, 0, 1), (2, 3, 2), (3, 0, 1), (3, 2, 2)]


def test_blocks_stay_bounded():
    for postings, docs, tasks in ((160_000_000, 512_000, 100), (16_000_000, 51_282, 12), (1_000_000, 1_000_000, 12), (10, 2, 200), (0, 0, 8)):
        n, parts = crossed.grid(postings, docs, tasks)
        assert 1 <= parts <= n and postings <= n * bounded.BLOCK and docs <= n * crossed.DOCS
        assert n * parts >= min(tasks, n * n)
    assert crossed.grid(160_000_000, 512_000, 100)[1] == crossed.grid(960_000_000, 3_072_000, 600)[1] == crossed.PARTS
