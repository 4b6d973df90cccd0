"""File readers and writers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def read_corpus_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """CSV with header, comma or tab separated, quoted fields may hold newlines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV / TSV with header; quotes doubled so S1 reads it back unchanged."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)


def read_examples_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Prompt / context / target JSON lines; returns (good, bad) where bad
    rows (not JSON, or without a target) keep the raw line; blank lines are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", F.from_json("value", EXAMPLE_SCHEMA, options).alias("r"))
    ok = F.col("r._corrupt").isNull() & F.col("r.target").isNotNull()
    return rows.filter(ok).select("r.prompt", "r.context", "r.target"), rows.filter(~ok).select(F.col("value").alias("raw"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text, one row per line, with the file name."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("file"))


def read_json_records(spark: SparkSession, path: str, key: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array of records keyed by ``key``, for lookups by join."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path)
    return df.select(F.col(key).alias("key"), *[c for c in df.columns if c != key])


def write_json_records(df: DataFrame, path: str, key: str, rows_per_file: int = 50_000) -> None:
    """S7 writer: JSON arrays of records, one array per file.  Rows are cut into
    hash buckets sized from the row count, so no file (and no group) grows with
    the table."""
    n = max(1, -(-df.count() // rows_per_file))
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(n)).alias("_bucket")
    arrays = df.groupBy(b).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.write.partitionBy("_bucket").text(path)
