"""The corpus pipeline: quality rules, exact and near duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
The filtering stages return the columns of ``documents`` as they came, source mixing
with rows repeated as often as the mix copies them, at most ``mixing.MAX_COPIES`` times;
the last one returns the packed pieces, with the number of the copy they belong to.  Rows are chosen by doc_id, null-safe; rows that share a doc_id stay or go
together.  Empty tables stay empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm import exact, mixing, packing, quality, queries, simhash
from corpusmill.llm.common import ensure_checkpoint_dir


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose id is in ``kept``."""
    ids = kept.select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept"]), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    rows = docs.select("doc_id", "text", whole)
    return quality.judge(rows, keep=["_row"]).where("kept").select("_row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, exact.dedup(docs).where("kept"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(docs, words=4, max_bits=4)
    return _only(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As often as the mix copies them; rows that share a doc_id alike."""
    kept = mixing.mix(docs).where("kept").groupBy(F.col("doc_id").alias("_kept")).agg(F.max("copies").alias("_copies"))
    found = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]))
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    repeated = found.select(F.explode(F.array_repeat(whole, kept["_copies"].cast("int"))).alias("_row"))
    return repeated.select("_row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of equal documents are told apart by ``copy``, from 1."""
    packed = packing.pack(docs, queries.vocabulary(), queries.LIMIT, queries.END_ID)
    order = Window.partitionBy("doc_id", "piece", "start", "length", "ids_crc32").orderBy("sequence_id", "offset")
    return packed.withColumn("copy", F.row_number().over(order))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# XXH64 fingerprints and byte-pair ids have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written and read again."""
    import uuid

    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
