"""Give rows the corpus shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bind_roles(df: DataFrame, id_col: str, strong, weak, reference=()) -> DataFrame:
    """(doc_id, strong, weak, ref struct) from several strong / weak columns."""
    strong = [strong] if isinstance(strong, str) else list(strong)
    weak = [weak] if isinstance(weak, str) else list(weak)
    cols = [
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c in strong]).alias("strong"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c in weak]).alias("weak") if weak else F.lit("").alias("weak"),
    ]
    if reference:
        cols.append(F.struct(*[F.col(c) for c in reference]).alias("ref"))
    return df.select(*cols)


def corpus_from_texts(df: DataFrame, name_col: str, texts_col: str) -> DataFrame:
    """S3: named lists of texts to one document row per text."""
    return df.select(
        F.col(name_col).alias("source"), F.posexplode(texts_col).alias("chunk_no", "text")
    ).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def read_qrels(df: DataFrame, query_col: str, ids_col: str, delim: str = ":") -> DataFrame:
    """One row per (query, id); ids that are not integers are dropped."""
    import re

    return (
        df.select(F.col(query_col).alias("query"), F.explode(F.split(F.col(ids_col), re.escape(delim))).alias("_id"))
        .select("query", F.expr("try_cast(trim(_id) AS BIGINT)").alias("doc_id"))
        .filter(F.col("doc_id").isNotNull())
    )


def union_sources(frames: list[DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Many sources in one insert, each tagged with its position as source_id."""
    out = None
    for i, df in enumerate(frames):
        part = df.select(F.lit(i).cast("bigint").alias("source_id"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out
