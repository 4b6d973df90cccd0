"""Documents by (source, id)."""

from corpusmill.operators import index as ix
from corpusmill.operators import sourced as sd


def hits(found, ask, k=9):
    return sorted((r["query_id"], r["source_id"], r["doc_id"], r["score"]) for r in sd.search(found, ask, k).collect())


def test_equal_ids_of_two_sources(spark):
    a = spark.createDataFrame([(1, "red apple pie"), (2, "green apple"), (None, "no id apple")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "apple computer"), (3, "pear"), (3, "apple")], "doc_id long, text string")
    ask = spark.createDataFrame([(7, "apple"), (8, "pear pie")], "query_id long, text string")
    both, one = sd.insert(sd.empty(spark), a, "fruit")
    both, two = sd.insert(both, b, "firms")
    assert one != two and both.n_docs == 4
    assert {r["source_id"]: r["n_docs"] for r in sd.sources(both).collect()} == {one: 2, two: 2}
    assert {(s, d) for q, s, d, _ in hits(both, ask) if q == 7} == {(one, 1), (one, 2), (two, 1), (two, 3)}
    # ids that a source has are skipped; new ones are added; the name gives the id
    more = spark.createDataFrame([(2, "changed"), (9, "apple tart")], "doc_id long, text string")
    again, same = sd.insert(both, more, "fruit")
    assert same == one and {r["source_id"]: r["n_docs"] for r in sd.sources(again).collect()} == {one: 3, two: 2}
    assert (one, 9) in {(s, d) for _, s, d, _ in hits(again, ask)}
    unchanged, _ = sd.insert(again, more, "fruit")
    assert hits(unchanged, ask) == hits(again, ask)


def test_forgetting_equals_never_knowing(spark):
    a = spark.createDataFrame([(i, f"word{i % 3} common thing") for i in range(6)], "doc_id long, text string")
    b = spark.createDataFrame([(i, f"word{i % 2} other thing") for i in range(4)], "doc_id long, text string")
    ask = spark.createDataFrame([(1, "word1 thing"), (2, "other word0")], "query_id long, text string")
    both, one = sd.insert(sd.empty(spark), a, "a")
    only = hits(both, ask)
    both, two = sd.insert(both, b, "b")
    assert hits(sd.forget(both, two), ask) == only != hits(both, ask)
    some = sd.forget(both, one, a.where("doc_id < 4").select("doc_id"))
    rest = ix.build_index(a.where("doc_id >= 4"), "doc_id")
    assert some.n_docs == 6 and rest.n_docs == 2
    assert {(s, d) for _, s, d, _ in hits(some, ask)} <= {(one, 4), (one, 5), *[(two, i) for i in range(4)]}
    assert hits(sd.forget(sd.forget(both, one), two), ask) == [] and sd.search(sd.empty(spark), ask).count() == 0
