"""Sign codes, buckets to look into and recall against the exact neighbours."""

import numpy as np

from corpusmill.operators import evaluate as ev
from corpusmill.operators import vectors as vx
from corpusmill.plans.registry import load
from tests.conftest import MID


def test_recall_at_ten(spark):
    for sf in (MID, "/root/testdata/sf0.1"):
        e = load(spark, sf, "embeddings")
        exact = vx.knn(e, e, 10).select("query_id", "doc_id")
        assert ev.recall_at_k(vx.knn_approx(e, e, 10), exact, 10).first()[0] >= 0.9


def test_nearest_buckets_first():
    margin = np.random.default_rng(1).standard_normal((50, 7))
    got = vx.probed(margin, 20)
    for row, m in zip(got, margin):
        cost = lambda b: sum(x * x for i, x in enumerate(m) if (b >> i & 1) != (x >= 0))
        want = sorted(range(128), key=cost)[:20]
        assert row.tolist() == want
    assert vx.probed(np.empty((3, 0)), 5).tolist() == [[0]] * 3


def test_buckets_on_clustered_vectors(spark):
    """Many buckets, few of them looked into: clusters are still found; a hot bucket
    is cut into blocks; a null vector is left out."""
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((40, 16))
    x = centre[rng.integers(0, 40, 1500)] + 0.1 * rng.standard_normal((1500, 16))
    x[:500] = centre[0] + 0.1 * rng.standard_normal((500, 16))
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "vec_id long, embedding array<double>")
    q = e.where("vec_id % 20 = 0")
    got = vx.knn_approx(q, e, 5, bucket=64, n_probes=8, short_list=40)
    assert ev.recall_at_k(got, vx.knn(q, e.where("embedding is not null"), 5).select("query_id", "doc_id"), 5).first()[0] >= 0.9
    assert vx.knn_approx(q, e.limit(0), 5).count() == 0


def test_planes_are_a_table(spark):
    p = vx.planes(spark, 8, 16)
    assert p.columns == ["bit", "signs"] and p.count() == 16
    assert {x for r in p.collect() for x in r["signs"]} == {1.0, -1.0}
