"""Hand cases for limits and faults that were removed: each at the old limit."""

import json
import os
import uuid

from corpusmill.operators import classify as cl
from corpusmill.operators import features as fx
from corpusmill.operators import index as ix
from corpusmill.operators import prep
from corpusmill.operators import tagging as tg
from corpusmill.operators.ordered import last_k_before
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources import files, store
from corpusmill.streaming import jobs


def scratch(spark, name):
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return path[len("file:"):] if path.startswith("file:") else path


def test_validate_counts_unreadable_values(spark):
    df = spark.createDataFrame([("abc", "x", "2024-13-45"), ("1.5", "2", "2024-12-31"), (None, None, None)], "n string, c string, d string")
    spec = fx.FeatureSpec({"n": fx.Numerical(range=(0.0, 2.0)), "c": fx.Categorical(type="int"), "d": fx.Date()})
    assert {r["column_name"]: r["violations"] for r in fx.validate(df, spec).collect()} == {"n": 2, "c": 2, "d": 2}


def test_examples_keep_the_raw_line_without_target(spark):
    path = scratch(spark, "jsonl")
    os.makedirs(path)
    no_target = json.dumps({"prompt": "p"})
    with open(f"{path}/a.jsonl", "w") as f:
        f.write("\n".join([json.dumps({"prompt": "p", "context": "c", "target": "t"}), no_target, "{broken", ""]))
    good, bad = files.read_examples_jsonl(spark, path)
    assert [tuple(r) for r in good.collect()] == [("p", "c", "t")]
    assert sorted(r["raw"] for r in bad.collect()) == sorted([no_target, "{broken"])


def test_history_longer_than_a_chunk(spark):
    df = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 0)], "k string, t int")
    got = {(r["k"], r["t"]): r["history"] for r in last_k_before(df, "k", "t", 5, "t", chunk_rows=2).collect()}
    assert got[("b", 0)] == [] and len(got) == 21
    assert all(got[("a", t)] == list(range(max(0, t - 5), t)) for t in range(20))


def test_noisy_copy_keeps_the_whole_text(spark):
    text = "x" * 1_000_500 + "end"
    df = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    rows = prep.noisy_queries(df, "text", "doc_id", 2).collect()
    assert len(rows) == 6 and all(abs(len(r["noisy"]) - len(text)) <= 1 for r in rows)


def test_chunk_number_beyond_one_hundred_thousand(spark):
    chunks = spark.createDataFrame([(1, 100_000, "alpha"), (2, 0, "beta")], "doc_id long, chunk_no long, text string")
    idx = ix.build_index(chunks.selectExpr("struct(doc_id, chunk_no) AS id", "text"), "id", "text")
    hits = ix.search(idx, spark.createDataFrame([(7, "alpha")], "query_id long, text string"), 3)
    assert [tuple(r) for r in hits.select("doc_id.doc_id", "doc_id.chunk_no").collect()] == [(1, 100_000)]


def test_masks_stand_where_the_finds_stand(spark):
    text = "94111111111111111999 and 4111111111111111, 4111111111111112"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in tg.redact(df).collect()}
    assert got == {1: "94111111111111111999 and [CARD], 4111111111111112", 2: "", 3: None}


def test_places_of_several_words_are_found_and_masked(spark):
    names = spark.createDataFrame([("NEW ZEALAND",), ("FRANCE",), ("NEW",)], "name string")
    df = spark.createDataFrame([(1, "From NEW ZEALAND to FRANCE, not FRANCES."), (2, "nowhere"), (3, None)], "doc_id long, text string")
    finds = sorted((r["doc_id"], r["value"]) for r in tg.detect_pii(df, gazetteer=names).collect())
    assert finds == [(1, "FRANCE"), (1, "NEW"), (1, "NEW ZEALAND")]
    got = {r["doc_id"]: r["text"] for r in tg.redact(df, gazetteer=names).collect()}
    assert got == {1: "From [LOCATION] to [LOCATION], not FRANCES.", 2: "nowhere", 3: None}


def test_stream_counts_a_repeated_id_once(spark):
    base = scratch(spark, "t2")
    schema = "doc_id long, text string"
    for i, rows in enumerate([[(1, "shared one"), (1, "shared two")], [(1, "shared three"), (2, "shared one"), (3, "other")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/part{i}")
        stream = spark.readStream.schema(schema).parquet(f"{base}/part*")
        jobs.insert_stream(spark, stream, f"{base}/store", f"{base}/ckpt")
    index = jobs.stored_index(spark, f"{base}/store")
    assert index.n_docs == 2
    assert {r["term"]: r["df"] for r in index.term_stats.collect()} == {"shared": 1, "one": 1, "other": 1}


def test_equal_rows_are_scored_each(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "f string, label string")
    feats = {"f": df["f"]}
    model = cl.fit_tabular(df, feats, "label")
    assert sorted(r["label"] for r in cl.predict_tabular(model, df, ["f"], feats).collect()) == ["x", "x", "y"]


def test_saved_models_come_back(spark):
    df = spark.createDataFrame([(1, "red apple", "a"), (2, "blue sky", "b")], "doc_id long, text string, label string")
    model, path = cl.fit_text(df, "doc_id", "text", "label"), scratch(spark, "model")
    store.save_model(model, path)
    back = store.load_model(spark, path, cl.CountModel)
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(back.term_counts) == key(model.term_counts) and key(back.class_counts) == key(model.class_counts)
    store.save_model(model.term_counts, f"{path}/one")
    assert key(store.load_model(spark, f"{path}/one")) == key(model.term_counts)


def test_similar_docs_uses_all_terms_by_default(spark):
    # the only shared word is the query's most common one, its 26th by weight
    docs = spark.createDataFrame(
        [(1, "shared " + " ".join(f"a{i}" for i in range(25))), (2, "shared b"), (3, "shared c"), (4, "d")], "doc_id long, text string"
    )
    idx, one = ix.build_index(docs), spark.createDataFrame([(1,)], "doc_id long")
    assert sorted(r["doc_id"] for r in ix.similar_docs(idx, one).collect()) == [2, 3]
    assert ix.similar_docs(idx, one, n_terms=20).count() == 0
