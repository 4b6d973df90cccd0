"""Work inside a row grows with the row, not with its square."""

import time

from pyspark.sql import functions as F

from corpusmill.functions.text import run_of, tokens, word_ngrams
from corpusmill.operators import prep


def seconds(df):
    start = time.time()
    rows = df.collect()
    return time.time() - start, rows


def test_ngrams_phrases_and_chunks_of_a_long_text(spark):
    """60,000 words in one row: minutes when the array is made or copied for every element."""
    words = [f"w{i}" for i in range(60_000)]
    df = spark.createDataFrame([(1, "t", " ".join(words))], "doc_id long, title string, text string").persist()
    df.count()
    took, rows = seconds(df.select(F.explode(word_ngrams(tokens("text"), 2)).alias("g")))
    assert [r["g"] for r in rows] == [f"{a} {b}" for a, b in zip(words, words[1:])] and took < 20
    took, rows = seconds(prep.cold_start_pairs(df, "doc_id", None, "text", 8))
    assert [r["query"] for r in sorted(rows, key=lambda r: r["piece"])] == [" ".join(words[i : i + 8]) for i in range(0, len(words), 8)] and took < 20
    lines = df.select("doc_id", F.translate("text", " ", "\n").alias("text"))
    took, rows = seconds(prep.chunk_text(lines, 5))
    assert [r["text"] for r in sorted(rows, key=lambda r: r["chunk_no"])] == [" ".join(words[i : i + 5]) for i in range(0, len(words), 5)] and took < 20


def test_short_and_empty_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, ""), (3, None), (4, "one")], "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", word_ngrams(tokens("text"), 2)).collect()}
    assert got[1] == ["a b", "b c"] and got[2] == [] and got[4] == []
    assert sorted((r["doc_id"], r["query"]) for r in prep.cold_start_pairs(df, "doc_id", None, "text", 2).collect()) == [(1, "a b"), (1, "c"), (4, "one")]
    assert sorted((r["doc_id"], r["chunk_no"], r["text"]) for r in prep.chunk_text(df, 2).collect()) == [(1, 0, "a b c"), (4, 0, "one")]
    long = spark.range(1).select(run_of(F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: i.cast("string")), F.lit(5), 20).alias("r"))
    assert long.first()[0] == " ".join(str(i) for i in range(5, 25))
