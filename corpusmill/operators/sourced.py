"""D9, D10 by source: documents of several sources in one index, each known by
(source id, document id).

The index itself goes by ``doc_key``, dense numbers that rise with every insert, so that all
of the search operators apply; ``keys`` holds what each number stands for.  Ties of a
search go to the source that came first, then to the smaller document id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import index as ix
from corpusmill.operators.ordered import dense_ids


@dataclass(frozen=True)
class SourcedIndex:
    index: ix.Index
    keys: DataFrame  # doc_key bigint, source_id string, doc_id bigint
    next_key: int

    @property
    def n_docs(self) -> int:
        return self.index.n_docs


def empty(spark: SparkSession) -> SourcedIndex:
    nothing = spark.createDataFrame([], "doc_key long, text string")
    return SourcedIndex(ix.build_index(nothing, "doc_key"), spark.createDataFrame([], "doc_key long, source_id string, doc_id long"), 0)


def source_id(name: str) -> str:
    """The same name gives the same id, here and on every later run."""
    import hashlib

    return hashlib.sha256(name.encode()).hexdigest()[:16]


def insert(into: SourcedIndex, docs: DataFrame, name: str, id_col: str = "doc_id", fields="text") -> tuple[SourcedIndex, str]:
    """Adds a source, or more documents of one, and returns the source's id.
    Documents that the source already has are skipped; equal ids of other sources are
    other documents.  Of an id that comes twice the smallest text counts; rows without an
    id are left out."""
    sid = source_id(name)
    names = [fields] if isinstance(fields, str) else list(fields)
    whole = F.min(F.struct(*[F.col(f).cast("string").alias(f) for f in names])).alias("_whole")
    new = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_doc")).agg(whole).select("_doc", "_whole.*")
    had = into.keys.where(F.col("source_id") == sid).select(F.col("doc_id").alias("_doc"))
    new = new.join(had, "_doc", "left_anti")
    ids = dense_ids(new.select("_doc"), ["_doc"], "_n").select("_doc", (F.col("_n") + F.lit(into.next_key)).cast("bigint").alias("doc_key"))
    ids = ids.persist(StorageLevel.MEMORY_AND_DISK)
    n = ids.count()
    if n == 0:
        return into, sid
    index = ix.insert(into.index, new.join(ids, "_doc").drop("_doc"), "doc_key", fields)
    keys = into.keys.unionByName(ids.select("doc_key", F.lit(sid).alias("source_id"), F.col("_doc").alias("doc_id")))
    return SourcedIndex(index, keys, into.next_key + n), sid


def forget(out_of: SourcedIndex, sid: str, doc_ids: DataFrame | None = None) -> SourcedIndex:
    """Forgets a source, or the listed documents of it."""
    gone = out_of.keys.where(F.col("source_id") == sid)
    if doc_ids is not None:
        gone = gone.join(doc_ids.select(F.col(doc_ids.columns[0]).cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi")
    gone = gone.select("doc_key").persist(StorageLevel.MEMORY_AND_DISK)
    return SourcedIndex(ix.clear(out_of.index, gone), out_of.keys.join(gone, "doc_key", "left_anti"), out_of.next_key)


def sources(of: SourcedIndex) -> DataFrame:
    """(source_id, n_docs) of what is there."""
    return of.keys.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_docs"))


def search(within: SourcedIndex, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, source_id, doc_id, rank, score)."""
    hits = ix.search(within.index, queries, k).withColumnRenamed("doc_id", "doc_key")
    return hits.join(within.keys, "doc_key").select("query_id", "source_id", "doc_id", "rank", "score")
