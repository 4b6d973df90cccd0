"""Former limits: short items, hub nodes, earlier turns; stored link tables."""

import random
from collections import defaultdict

import numpy as np

from corpusmill.operators import graph as gr
from corpusmill.operators import index as ix
from corpusmill.operators import prep
from corpusmill.sources import html


def test_short_items_match_brute_force(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcé -") for _ in range(rng.randint(1, 7)))
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(98, None), (99, "")]
    items = [(i, t) for i, t in enumerate(["a", "ab", "abc", "abca", "é", "- ", "zz", "", None, "ab", " a", "abca bc", *[word() for _ in range(40)]])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    index = ix.build_index(d)
    short = lambda t: t and len([x for x in "".join(c if c.isalnum() else " " for c in t).split()]) < 3
    want = sorted((i, n) for i, t in items for n, text in docs if short(t) and text and t in text)
    got = sorted(tuple(r) for r in ix.containing_docs(index, d, it.where("length(text) < 8")).collect())
    assert [g for g in got if short(dict(items)[g[0]])] == want and want
    assert ix.containing_docs(index, d, it.limit(0)).count() == 0


def test_many_short_items_need_no_driver(spark):
    """More short items than the local automaton took."""
    d = spark.createDataFrame([(1, "say xq77 and xq99999 now"), (2, "nothing")], "doc_id long, text string")
    it = spark.range(1_000_500).selectExpr("id AS item_id", "concat('xq', cast(id AS string)) AS text")
    got = sorted(tuple(r) for r in ix.containing_docs(ix.build_index(d), d, it).collect())
    assert got == [(7, 1), (9, 1), (77, 1), (99, 1), (999, 1), (9999, 1), (99999, 1)]


def test_hub_means_match_numpy(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vec = {i: rng.standard_normal(5).tolist() for i in range(300)}
    vec[7] = [1.0, None, 2.0]
    vec[8] = None
    edges = [(1, i) for i in range(300)] + [(2, 7), (2, 9), (3, 8), (4, 7), (1, 5), (5, 999)]
    nodes = spark.createDataFrame([(i, v) for i, v in vec.items()], "node_id long, features array<double>")
    sums = defaultdict(list)
    for s, t in edges:
        for k, x in enumerate(vec.get(t) or []):
            if x is not None:
                sums[s, k].append(x)
    want = {k: np.mean(v) for k, v in sums.items()}
    for hub in (10_000, 50):  # one part, then several
        monkeypatch.setattr(gr, "HUB", hub)
        got = {(r["node_id"], r["dim"]): r["mean"] for r in gr.neighbor_features(nodes, spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_any_number_of_earlier_turns(spark):
    talk = spark.createDataFrame(
        [(1, i, "assistant" if i % 2 else "user", f"t{i} x") for i in range(6)] + [(1, 6, "user", None), (1, 7, "assistant", "end")], "conv_id long, turn long, role string, text string"
    )
    got = {r["turn"]: (r["tokens"], r["labels"]) for r in prep.lm_examples(talk, n_before=4).collect()}
    assert got[5] == (["t1", "x", "t2", "x", "t3", "x", "t4", "x", "t5", "x"], [0] * 8 + [1] * 2)
    assert got[1] == (["t0", "x", "t1", "x"], [0, 0, 1, 1]) and got[7][0] == ["t3", "x", "t4", "x", "t5", "x", "end"]


def test_reach_over_a_stored_link_table(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "") for i in range(6)], "page_id long, url string, html string")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (0, 3), (3, 4), (4, 5), (0, 1)], "src long, dst long")
    starts = pages.where("page_id in (0, 2)").selectExpr("page_id AS start")
    got = {(r["start"], r["page_id"]): r["depth"] for r in html.link_reach(pages, starts, 2, edges).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (0, 3): 1, (0, 2): 2, (0, 4): 2, (2, 2): 0, (2, 0): 1, (2, 1): 2, (2, 3): 2}


def test_blocks_are_cut_inside_examples(spark):
    rng = random.Random(1)
    data = [(c, t, [f"{c}.{t}.{i}" for i in range(rng.choice([0, 1, 5, 23]))]) for c in range(6) for t in range(5)]
    df = spark.createDataFrame(data, "conv_id long, turn long, tokens array<string>")
    got = {r["block"]: r["tokens"] for r in prep.pack_tokens(df, 7).collect()}
    stream = [x for _, _, toks in sorted(data) for x in toks]
    assert got == {i: stream[7 * i : 7 * i + 7] for i in range(-(-len(stream) // 7))}
    shards = prep.pack_tokens(df, 7, 2).collect()
    assert sorted(x for r in shards for x in r["tokens"]) == sorted(stream) and {len(r["tokens"]) for r in shards} <= set(range(1, 8))


def test_broadcast_is_bounded_by_bytes(spark):
    from corpusmill.session import bounded_broadcast

    wide = spark.createDataFrame([(1, "x" * 5000, [1, 2], {"a": 1.0}), (2, None, None, None)], "id long, text string, l array<long>, m map<string,double>")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower() or "hint" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(wide)) and not hinted(bounded_broadcast(wide, max_bytes=4000)) and not hinted(bounded_broadcast(wide, max_rows=1))
    assert hinted(bounded_broadcast(wide.limit(0)))
