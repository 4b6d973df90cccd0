"""Session helpers: configuration, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side we hand to ``broadcast``, in bytes of its values and in rows.  Query-term
# tables, feedback tables and dictionaries are checked against both; anything larger
# falls back to a shuffle join that AQE may still turn into a broadcast at run time.
BROADCAST_MAX_BYTES = 128 << 20
BROADCAST_MAX_ROWS = 2_000_000


def get_session(cpus: int | str = "*", app: str = "corpusmill", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests and the bench; on a cluster use the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.ansi.enabled", os.environ.get("CORPUSMILL_ANSI", "true"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one gets a scratch folder
    of its own (tests, bench).  On a cluster without one we refuse rather than
    write lineage cuts to a machine-local disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    path = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the folder or file is there; a store that cannot be reached raises."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan that arrived in too few partitions (one row group per
    file loads as one task).  On a cluster the scan already has thousands of
    splits and this is a no-op, so no extra shuffle is paid at scale."""
    spark = df.sparkSession
    want = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *[F.col(k) for k in keys]) if keys else df.repartition(want)


def value_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text and binary by length, nested values by their JSON,
    anything else eight."""
    out = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            out = out + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0))
        else:
            out = out + 8
    return out


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after measuring its rows and bytes in one pass; otherwise
    leave the join to the planner (sort-merge, AQE skew split, AQE runtime broadcast)."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(value_bytes(df)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["b"] <= max_bytes else df
