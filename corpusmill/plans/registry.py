"""Registry of named queries: Spark builder plus (optional) oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# Tables whose rows carry real work (text, many rows).  The test files hold one
# row group each, which Spark reads as a single task; ``spread`` redistributes
# such a scan and is a no-op when the scan already has enough splits.
# Spread by a unique id: no key skew, and per-document work (postings of a
# document) is then already co-located for the group-bys that follow.
_WIDE = {
    "documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "lineitem": "l_orderkey",
    "orders": "o_orderkey", "events": "event_id", "embeddings": "vec_id",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, _WIDE[name]) if name in _WIDE else df
