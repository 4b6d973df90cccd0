"""Persist and reload searchable state; resumable build."""

from __future__ import annotations

import json
from dataclasses import fields as fields_of

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import stable_hash
from corpusmill.operators.index import Index, build_index, term_bucket
from corpusmill.session import path_exists

N_BUCKETS = 64  # term buckets of stored postings
WRITERS = 4  # tasks that write a bucket
HASH = "xxhash64"  # what tells a term's bucket


def save_index(index: Index, path: str, n_buckets: int = N_BUCKETS, writers: int = WRITERS) -> None:
    """Postings and term statistics partitioned by term bucket, plus document lengths
    and the scalars.  A bucket is written by several tasks, so that a frequent term's
    postings do not wait for one."""
    spark = index.postings.sparkSession
    deal = F.pmod(F.xxhash64("doc_id", "term"), F.lit(writers))
    (index.postings.withColumn("bucket", term_bucket("term", n_buckets)).withColumn("_w", deal).repartition("bucket", "_w").drop("_w")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))
    index.doc_len.write.mode("overwrite").parquet(f"{path}/doc_len")
    index.term_stats.withColumn("bucket", term_bucket("term", n_buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/term_stats")
    meta = json.dumps({"n_docs": index.n_docs, "total_len": index.total_len, "n_buckets": n_buckets, "hash": HASH})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_index(spark: SparkSession, path: str) -> Index:
    """The stored index; a search on it reads the buckets of its query terms only, all of
    them where another hash told the buckets."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    postings, stats = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "term_stats"))
    return Index(
        postings.select("doc_id", "term", "tf", "dl"), spark.read.parquet(f"{path}/doc_len"), stats.select("term", "df"),
        int(meta["n_docs"]), float(meta["total_len"]), stored=(postings, stats, int(meta["n_buckets"])) if meta.get("hash") == HASH else None,
    )


def save_taught(path: str, pairs: DataFrame | None = None, boosts: DataFrame | None = None) -> None:
    """What a search was taught, beside its index: the association pairs of D6 and
    the upvotes of D7.  What D8 learned is part of the index itself."""
    for name, table in (("pairs", pairs), ("boosts", boosts)):
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/taught/{name}")


def load_taught(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(pairs, boosts); None for what was not stored."""
    found = (f"{path}/taught/{name}" for name in ("pairs", "boosts"))
    return tuple(spark.read.parquet(p) if path_exists(spark, p) else None for p in found)


def save_model(model, path: str) -> None:
    """Stores a trained model: the tables of a count model or tagger, each in a
    folder of its own, or one table (transitions, reformulation pairs)."""
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(path)
        return
    for f in fields_of(model):
        getattr(model, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}")


def load_model(spark: SparkSession, path: str, kind: type | None = None):
    """Reads back what ``save_model`` stored; ``kind`` is the model's class, or
    None for one table."""
    if kind is None:
        return spark.read.parquet(path)
    return kind(*[spark.read.parquet(f"{path}/{f.name}") for f in fields_of(kind)])


def build_resumable(corpus: DataFrame, path: str, n_buckets: int = 8, resume: bool = True, fields="text", stop_after: int | None = None) -> Index:
    """Build per document-hash bucket; each finished bucket is committed by
    a manifest line written after its data, so a rerun with ``resume`` skips
    committed buckets (``left_anti`` against the manifest) and the result is
    the same table.  ``stop_after`` simulates an interrupted run."""
    spark = corpus.sparkSession
    manifest = f"{path}/_manifest"
    done: set[int] = set()
    if resume and path_exists(spark, manifest):
        done = {int(r[0]) for r in spark.read.text(manifest).collect()}  # at most n_buckets lines
    b = F.pmod(stable_hash(F.col("doc_id")), F.lit(n_buckets))
    built = 0
    for k in range(n_buckets):
        if k in done:
            continue
        if stop_after is not None and built >= stop_after:
            break
        part = build_index(corpus.filter(b == k), "doc_id", fields)
        part.postings.write.mode("overwrite").parquet(f"{path}/postings/b={k}")
        part.doc_len.write.mode("overwrite").parquet(f"{path}/doc_len/b={k}")
        spark.createDataFrame([(str(k),)], "v string").write.mode("append").text(manifest)
        part.release()
        built += 1
    postings = spark.read.parquet(f"{path}/postings").select("doc_id", "term", "tf", "dl")
    doc_len = spark.read.parquet(f"{path}/doc_len").select("doc_id", "dl")
    stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    row = doc_len.agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("t")).first()
    return Index(postings, doc_len, stats, int(row["n"]), float(row["t"] or 0.0))
