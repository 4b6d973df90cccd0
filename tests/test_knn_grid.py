"""The neighbour grid: few values looked through, few pairs leaving a group, dear edges made once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.operators import graph as gr
from corpusmill.operators import vectors as vx
from tests.test_crossed import shuffled


def test_kth_is_a_close_lower_bound():
    x = np.random.default_rng(3).standard_normal((20, 4103)).astype(np.float32)
    for k in (1, 5, 10, 300, 5000):
        got, n = vx._kth(x, k), x.shape[1]
        want = np.sort(x, axis=1)[:, n - k] if k < n else np.full(20, -np.inf)
        assert (got <= want).all()
        if k <= 10:
            assert ((x >= got[:, None]).sum(axis=1) <= 8 * k).all()


def test_ties_zero_vectors_and_own_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-2, 3, (300, 5)).astype(float)
    x[:3] = 0.0
    e = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    sims = np.round(unit @ unit.T, 6) + 0.0
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in vx.knn(e, e, 4).collect()}
    for i in range(300):
        want = sorted((j for j in range(300) if j != i), key=lambda j: (-sims[i, j], j))[:4]
        assert [got[i * 3, r] for r in (1, 2, 3, 4)] == [j * 3 for j in want]


def test_only_the_short_list_leaves_a_group():
    rng = np.random.default_rng(5)
    code, n = rng.integers(-(2**62), 2**62, (500, 4)), 500
    t = pa.table({"is_query": [True] * 5 + [False] * (n - 5), "id": np.arange(n), "code": pa.array(list(code), pa.list_(pa.int64())),
                  "v": pa.array(list(rng.standard_normal((n, 6))), pa.list_(pa.float64())), "limit": np.array([110] * 5 + [-1] * (n - 5))})
    far = np.bitwise_count(code[:5, None].view(np.uint64) ^ code[None, 5:].view(np.uint64)).sum(axis=2)
    got = vx._compared(50, True)(t)
    least = np.minimum(np.sort(far, axis=1)[:, 49], 110)
    assert got.num_rows == (far <= least[:, None]).sum() < 5 * 60


def test_edges_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src long, dst long").mapInPandas(count, "src long, dst long")
    nodes = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "node_id long, features array<double>")
    assert {r["node_id"]: r["mean"] for r in gr.neighbor_features(nodes, edges).collect()} == {0: 1.0, 1: 2.0, 2: 0.0}
    assert made.value == 3


def test_more_blocks_shuffle_no_more(spark, monkeypatch):
    """Vectors are shuffled once, however many blocks meet; and the answers stay."""
    rng = np.random.default_rng(6)
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((1200, 8)))], "vec_id long, embedding array<double>").cache()
    e.count()
    for find in (lambda: vx.knn(e, e, 3), lambda: vx.knn_approx(e, e, 3, bucket=100, n_probes=6)):
        rows, few = shuffled(spark, find)
        with monkeypatch.context() as m:
            m.setattr(vx, "BLOCK", 40)
            m.setattr(vx, "LEAST_BLOCK", 20)
            again, many = shuffled(spark, find)
        assert again == rows and len(rows) == 3600 and few > 0 and many < 4 * few
