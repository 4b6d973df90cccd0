"""The candidate filter of M17 loses nothing."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.operators import reform as rf
from corpusmill.plans.graph_queries import _reform
from corpusmill.plans.registry import load
from corpusmill.sources import html
from tests.conftest import MID
from tests.test_hand_cases import _lev


def _grams(s):
    s = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    return {s} if len(s) <= 3 else {s[i : i + 3] for i in range(len(s) - 2)}


def test_nearest_targets_match_every_pair(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcAB é") for _ in range(n))
    targets = sorted({word(rng.choice([0, 1, 2, 3, 4, 9, 10, 30])) for _ in range(150)} | {"common start " + word(8) for _ in range(60)})
    queries = [(i, word(rng.choice([0, 2, 3, 5, 9, 12]))) for i in range(60)]
    queries += [(100 + i, t[:7] + rng.choice(["", "x"]) + t[8:]) for i, t in enumerate(rng.sample(targets, 60))] + [(900, None), (901, "zzzzzz")]
    t = spark.createDataFrame([(x,) for x in [*targets, *targets[:5], None]], "target string")
    q = spark.createDataFrame(queries, "query_id long, query string")
    for k in (1, 4):
        want = set()
        for i, text in queries:
            near = sorted((_lev(text, x), x) for x in targets if _grams(x) & _grams(text)) if text is not None else []
            want |= {(i, x, n, d, 0) for n, (d, x) in enumerate(near[:k], 1)}
        assert {tuple(r) for r in rf.reformulate(t, q, k).collect()} == want
    assert rf.reformulate(t.limit(0), q, 2).count() == 0 == rf.reformulate(t, q.limit(0), 2).count()


def test_learned_pairs_come_first(spark):
    t = spark.createDataFrame([("running shoes",), ("running socks",)], "target string")
    q = spark.createDataFrame([(1, "runing shoes"), (2, "trainers")], "query_id long, query string")
    pairs = spark.createDataFrame([("trainers", "running shoes"), ("trainers", "running shoes"), ("other", "running socks")], "source string, target string")
    got = sorted(tuple(r) for r in rf.reformulate(t, q, 1, pairs).collect())
    assert got == [(1, "running shoes", 1, 1, 0), (2, "running shoes", 1, _lev("trainers", "running shoes"), 1)]


def test_few_pairs_are_compared(spark):
    """Misspelt titles: pairs that come to the edit distance, of all that share a gram."""
    noisy, _ = _reform(spark, MID, 3)
    titles = html.html_to_corpus(load(spark, MID, "pages")).select(F.col("title").alias("target")).distinct()
    q = noisy.select("query").distinct()
    every = q.select("query", F.explode(rf.grams("query")).alias("g")).join(titles.select("target", F.explode(rf.grams("target")).alias("g")), "g")
    every = every.select("query", "target").distinct().count()
    kept = rf.candidates(titles, q, 1).count()
    assert kept < 0.05 * every


def test_a_far_kth_target_is_found_in_blocks(spark, monkeypatch):
    """Queries whose k-th target is far off do not meet the targets gram by gram."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdeé €") for _ in range(n))
    targets = sorted({text(rng.choice([5, 40, 63, 64, 65, 129, 200])) for _ in range(90)})
    queries = [t[:3] + "x" + t[4:] for t in targets[::3]] + ["", "zz", text(70), text(128)]
    t, q = spark.createDataFrame([(x,) for x in targets], "target string"), spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    met = []
    whole = rf._meeting
    monkeypatch.setattr(rf, "_meeting", lambda qg, tg: met.append(whole(qg, tg)) or met[-1])
    monkeypatch.setattr(rf, "BLOCK", 20, raising=False)
    want = set()
    for i, text in enumerate(queries):
        near = sorted((_lev(text, x), x) for x in targets if _grams(x) & _grams(text))
        want |= {(i, x, n, d, 0) for n, (d, x) in enumerate(near[:3], 1)}
    assert {tuple(r) for r in rf.reformulate(t, q, 3).collect()} == want
    assert met[-1].count() < 0.2 * len(targets) * len(queries)


def _texts(rng, n, most=140):
    return sorted({"".join(rng.choice("abcdeé €") for _ in range(rng.choice([0, 1, 5, 40, 63, 64, 65, 128, 129, most]))) for _ in range(n)})


def test_distances_of_many_at_once(monkeypatch):
    rng = random.Random(8)
    a, b = _texts(rng, 60), _texts(rng, 20)
    for words in (rf.WORDS, 300):
        monkeypatch.setattr(rf, "WORDS", words)
        lanes, coded = rf.Lanes(a), rf.Coded(a, b)
        for i, x in enumerate(b):
            want = [_lev(y, x) for y in a]
            assert lanes.distances(x).tolist() == want
            assert coded.distances(np.arange(len(a)), np.full(len(a), len(a) + i)).tolist() == want


def test_blocks_and_centres_lose_nothing(spark, monkeypatch):
    """Misspelt targets among far ones, in several blocks, with and without a centre."""
    rng = random.Random(9)
    targets = sorted({"".join(rng.choice("abcdeé ") for _ in range(rng.choice([8, 30, 60, 70]))) for _ in range(120)})
    queries = [t[:3] + "x" + t[4 + n % 2 :] for n, t in enumerate(targets)] + ["", "zz", "zab", *_texts(rng, 8)]
    t, q = spark.createDataFrame([(x,) for x in targets], "target string"), spark.createDataFrame([(x,) for x in dict.fromkeys(queries)], "query string")
    monkeypatch.setattr(rf, "BLOCK", 50)
    monkeypatch.setattr(rf, "FEW", 3)
    monkeypatch.setattr(rf, "SEEDS", 20)
    centred = {r["query"]: r for r in rf._centred(t, q).collect()}
    assert 50 <= sum(r["centre"] is not None for r in centred.values()) < len(centred)
    assert all(r["far"] == _lev(r["query"], r["centre"]) <= rf.NEAR for r in centred.values() if r["centre"] is not None)
    want = set()
    for text in set(queries):
        near = sorted((_lev(text, x), x) for x in targets if _grams(x) & _grams(text))
        want |= {(text, x, d) for d, x in near[:3]}
    limited = q.selectExpr("query", "CAST(NULL AS INT) AS limit")
    got = {tuple(r) for r in rf._by_block(t, limited, 3).collect()}
    assert want <= got
    best = {}
    for text, x, d in got:
        best.setdefault(text, []).append((d, x))
    assert {(text, x, d) for text, near in best.items() for d, x in sorted(near)[:3]} == want


def test_queries_of_one_centre_meet_few_targets(monkeypatch):
    """Three misspelt copies of each target cost little more than the targets among themselves."""
    rng = random.Random(10)
    targets = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(400)]
    queries = [(t[:i] + "x" + t[i + 1 :], t) for t in targets for i in (5, 25, 50)]
    met = [0]
    whole = rf.Coded.distances
    monkeypatch.setattr(rf.Coded, "distances", lambda self, a, b: met.__setitem__(0, met[0] + len(a)) or whole(self, a, b))
    rows = [(True, t, q, 1, 46) for q, t in queries] + [(False, t, None, None, None) for t in targets]
    lane, text, query, far, limit = zip(*rows)
    table = pa.table({"a": pa.array([0] * len(rows), pa.int32()), "b": pa.array([0] * len(rows), pa.int32()), "r": pa.array([0] * len(rows), pa.int32()), "lane": lane, "text": text, "query": query, "far": pa.array(far, pa.int64()), "limit": pa.array(limit, pa.int64())})
    found = rf._block_best(1)(table)
    assert sorted(zip(found["query"].to_pylist(), found["target"].to_pylist())) == sorted(queries)
    assert met[0] < 0.2 * len(queries) * len(targets)
