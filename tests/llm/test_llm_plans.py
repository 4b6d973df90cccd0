"""The pipeline, native plans and the registration."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from corpusmill.llm import quality, queries
from tests.conftest import SMALL
from tests.llm.test_llm_ops import brute_components, brute_exact, brute_print, check_packing, pairs, rows, tokenizer  # noqa: F401


def test_all_operators_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["op3_personal_data", "op5_quality", "op8_mixing", "op9_url_filter", "op10_exact_dedup"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_pipeline_stages_match_brute_force(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    one = spark.createDataFrame(rows(stage["quality rules"](spark, docs, SMALL)), docs.schema)
    judged = {r["doc_id"] for r in queries.op5_quality(spark, SMALL).where("kept").collect()}
    assert {r["doc_id"] for r in one.collect()} == judged
    two = spark.createDataFrame(rows(stage["exact dedup"](spark, one, SMALL)), docs.schema)
    assert sorted(str(i) for i, _ in pairs(two)) == sorted(r[0] for r in brute_exact(pairs(one)) if r[3])
    three = spark.createDataFrame(rows(stage["SimHash near-dedup"](spark, two, SMALL)), docs.schema)
    want = brute_components([(i, brute_print(t)) for i, t in pairs(two)], 4)
    assert sorted(str(i) for i, _ in pairs(three)) == sorted(d for d, _, c in want if d == c)
    four = stage["source mixing"](spark, three, SMALL)
    assert four.columns == columns and 0 < four.count() <= three.count()
    four = spark.createDataFrame(rows(four), docs.schema)
    five = rows(stage["best-fit packing"](spark, four, SMALL))
    check_packing(five, pairs(four), tokenizer)
    run = rows(corpus_pipeline.run(spark, SMALL))
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, run)) == Counter(map(key, five))
    assert len({(*key(r), r["copy"]) for r in run}) == len(run)


def test_pipeline_takes_awkward_rows(spark):
    words = "the word and a text with more of it to read than that one "
    data = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, words * 3, "en", "a", 1), (4, "a b c " * 9000, "en", "a", 1), (5, words + "five", "en", "a", 1)]
    data += [(6, data[4][1], "en", "b", 1), (7, " ".join(f"the w{i} of and" for i in range(200)), None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", F.lit(1).alias("_copy"), F.lit("x").alias("a.b"), F.lit(2).alias("_row"), F.lit(3).alias("copies"))
    quality_, exact_, near, mixed, packed = (stage for _, stage in corpus_pipeline.STAGES)
    ids = lambda df: sorted(str(r["doc_id"]) for r in df.select("doc_id").collect())
    one = quality_(spark, docs, SMALL)
    assert one.columns == docs.columns
    judged = quality.judge(docs.select("doc_id", "text"))
    assert ids(one) == ids(judged.where("kept")) and not {"1", "2", "4"} & set(ids(one))
    two = exact_(spark, docs, SMALL)
    assert two.columns == docs.columns and ids(two) == sorted(["1", "4", "5", "7", "None"])  # 2 is empty like 1, 6 equals 5
    assert ids(near(spark, two, SMALL)) == ids(two)
    three = mixed(spark, two, SMALL)
    assert three.columns == docs.columns and set(ids(three)) <= set(ids(two))
    assert {r["doc_id"] for r in packed(spark, two, SMALL).collect()} == {1, 4, 5, 7, None}
    for stage in (quality_, exact_, near, mixed, packed):
        assert rows(stage(spark, docs.limit(0), SMALL)) == []
