"""The tagger reads its rows once, and personal data its texts once."""

from pyspark.sql import functions as F

from corpusmill.operators import features as fx
from corpusmill.operators import tagging as tg

DOCS = [(1, "Anna met 12 Bens", "B-PER O B-NUM B-PER"), (2, "", ""), (3, "  ", ""), (4, "anna slept", "B-PER O"), (5, "one two", "O")]


def test_given_previous_tags_equal_the_windows(spark):
    docs = spark.createDataFrame(DOCS, "row_id long, text string, tags string")
    kinds = ["B-PER", "B-NUM"]
    plain, bad = fx.align_tags(docs, "row_id", "text", "tags", kinds)
    given, _ = fx.align_tags(docs, "row_id", "text", "tags", kinds, previous=True)
    assert [r["row_id"] for r in bad.collect()] == [5] and given.count() == plain.count() == 6
    a, b = tg.fit_tagger(plain), tg.fit_tagger(given)
    for name in ("word_tag", "shape_tag", "trans", "tag_counts"):
        assert sorted(map(tuple, getattr(a, name).collect())) == sorted(map(tuple, getattr(b, name).collect())), name
    assert {tuple(r) for r in b.word_tag.where("token = 'anna'").collect()} == {("anna", "B-PER", 2.0)}
    assert {tuple(r) for r in b.trans.where("prev_tag = '<s>'").collect()} == {("<s>", "B-PER", 2.0)}
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            made.add(len(x))
            yield x

    once = tg.fit_tagger(given.mapInPandas(count, given.schema))
    for name in ("word_tag", "shape_tag", "trans", "tag_counts"):
        getattr(once, name).collect()
    assert made.value == 6


def test_rules_run_once_beside_a_gazetteer(spark):
    docs = spark.createDataFrame([(1, "Mail a@x.org from NEW ZEALAND, NEW  ZEALAND or PERU 123-45-6789."), (2, None), (3, "")], "doc_id long, text string")
    names = spark.createDataFrame([("PERU",), ("NEW ZEALAND",)], "name string")
    found = tg.detect_pii(docs, "doc_id", "text", names)
    assert sorted((r["kind"], r["value"]) for r in found.collect()) == [("EMAIL", "a@x.org"), ("LOCATION", "NEW ZEALAND"), ("LOCATION", "PERU"), ("SSN", "123-45-6789")]
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            made.add(len(x))
            yield x

    tg.detect_pii(docs.mapInPandas(count, docs.schema), "doc_id", "text", names).agg(F.count("kind")).collect()
    assert made.value == 3
