"""Global order without a global window.

``dense_ids`` and ``running_totals`` range-partition the rows, number them
inside each partition, and add per-partition offsets computed from a table with
one row per partition (bounded by the partition count, so it is broadcast).
The range-partitioned rows are checkpointed to the shared checkpoint folder, so
a lost executor recomputes the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | row position


def _ranged(df: DataFrame, order: list, n_parts: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    out = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", mid)
        .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_mid")
    )
    return out.checkpoint(eager=True)


def dense_ids(df: DataFrame, order, id_col: str = "id", n_parts: int | None = None) -> DataFrame:
    """Ids 0..n-1 following ``order`` (a list of columns; make it a total order)."""
    order = [order] if isinstance(order, str) else list(order)
    ranged = _ranged(df, order, n_parts)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "_off"
        ),
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, (F.col("_off") + F.col("_pos")).cast("bigint"))
        .drop("_pid", "_pos", "_off")
    )


def running_totals(df: DataFrame, order, values, suffix: str = "_before", n_parts: int | None = None) -> DataFrame:
    """For each row, the sums of ``values`` over all rows strictly earlier in ``order``."""
    order = [order] if isinstance(order, str) else list(order)
    values = [values] if isinstance(values, str) else list(values)
    ranged = _ranged(df, order, n_parts)
    per_part = ranged.groupBy("_pid").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    w_parts = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", *[F.coalesce(F.sum(f"_t_{v}").over(w_parts), F.lit(0)).alias(f"_o_{v}") for v in values])
    w_local = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(v).over(w_local), F.lit(0)).alias(f"_l_{v}") for v in values])
    out = local.join(F.broadcast(offsets), "_pid")
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_o_{v}") + F.col(f"_l_{v}"))
    return out.drop("_pid", "_pos", *[f"_o_{v}" for v in values], *[f"_l_{v}" for v in values])


def last_k_before(df: DataFrame, key: str, order, k: int, values, chunk_rows: int = 200_000, out: str = "history") -> DataFrame:
    """F11 core: for every row, the ``values`` of the k previous rows of the same
    key (in ``order``), oldest first.

    A plain window partitioned by key sends a hot key's rows to one task.  Here
    rows get global positions (``dense_ids``), are cut into chunks of
    ``chunk_rows`` positions, and each row is copied, as a halo, into every later
    chunk that holds one of the k positions after it; the window then runs per
    (key, chunk), so no group exceeds chunk_rows + k rows whatever the key skew."""
    order = [order] if isinstance(order, str) else list(order)
    values = [values] if isinstance(values, str) else list(values)
    g = dense_ids(df, [key, *order], "_g")
    g = g.withColumn("_chunk", F.expr(f"_g div {int(chunk_rows)}")).withColumn("_halo", F.lit(False))
    reach = F.expr(f"(_g + {int(k)}) div {int(chunk_rows)}")
    halo = g.filter(reach > F.col("_chunk")).withColumn("_chunk", F.explode(F.sequence(F.col("_chunk") + 1, reach)))
    both = g.unionByName(halo.withColumn("_halo", F.lit(True)))
    item = F.struct(*[F.col(v) for v in values]) if len(values) > 1 else F.col(values[0])
    w = Window.partitionBy(key, "_chunk").orderBy("_g").rowsBetween(-k, -1)
    return both.withColumn(out, F.collect_list(item).over(w)).filter(~F.col("_halo")).drop("_g", "_chunk", "_halo")
