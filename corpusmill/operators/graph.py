"""Node features from neighbours, node indexing and node classification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import classify as cl
from corpusmill.session import bounded_broadcast


# Edges of a node that one task adds up; a node with more is a hub, cut into so many parts.
HUB = 10_000


def _vector_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one (src, part) lie together: one row of sums and counts for each of them
    in a batch."""
    for pdf in batches:
        if pdf.empty:
            continue
        cut = np.flatnonzero((pdf["src"].to_numpy()[1:] != pdf["src"].to_numpy()[:-1]) | (pdf["part"].to_numpy()[1:] != pdf["part"].to_numpy()[:-1])) + 1
        first = np.concatenate([[0], cut])
        width = max(map(len, pdf["v"]))
        x = np.full((len(pdf), width), np.nan)
        for i, v in enumerate(pdf["v"]):
            x[i, : len(v)] = v
        there = ~np.isnan(x)
        sums, counts = np.add.reduceat(np.where(there, x, 0.0), first), np.add.reduceat(there.astype(np.int64), first)
        yield pd.DataFrame({"src": pdf["src"].to_numpy()[first], "sums": list(sums), "counts": list(counts)})


def neighbor_features(nodes: DataFrame, edges: DataFrame, id_col: str = "node_id", vec: str = "features") -> DataFrame:
    """(node_id, dim, mean) = mean of the neighbours' feature ``dim`` (long form).

    An edge carries its neighbour's whole vector in one row.  Vectors are added up per
    node, a hub's in parts of about HUB edges, so that no task's share grows with a hub;
    what is left, a row a part, is taken apart by dimension.  Missing features count
    for nothing.  The edges may be dear (a neighbour search) and are read for the hubs
    and for the sums, so they are kept."""
    e = edges.select("src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    side = nodes.select(F.col(id_col).alias("dst"), F.col(vec).cast("array<double>").alias("v")).where("v is not null and size(v) > 0")
    hubs = e.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB).select("src", F.ceil(F.col("n") / HUB).alias("parts"))
    part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("parts"))).cast("long")
    rows = e.join(side, "dst").join(bounded_broadcast(hubs), "src", "left").select("src", part.alias("part"), "v")
    kind = e.schema["src"].dataType.simpleString()
    summed = rows.repartition("src", "part").sortWithinPartitions("src", "part").mapInPandas(_vector_sums, f"src {kind}, sums array<double>, counts array<long>")
    long = summed.select(F.col("src").alias(id_col), F.posexplode(F.arrays_zip("sums", "counts")).alias("dim", "x"))
    means = long.groupBy(id_col, "dim").agg(F.sum("x.sums").alias("s"), F.sum("x.counts").alias("n")).where("n > 0")
    return means.select(id_col, F.col("dim").cast("bigint").alias("dim"), F.round(F.col("s") / F.col("n"), 6).alias("mean"))


def index_nodes(train: DataFrame, eval_: DataFrame, id_col: str, label: str) -> DataFrame:
    """Every node known before training; evaluation labels hidden (null)."""
    t = train.withColumn("is_eval", F.lit(False))
    e = eval_.withColumn(label, F.lit(None).cast(train.schema[label].dataType)).withColumn("is_eval", F.lit(True))
    return t.unionByName(e)


def binned(x: Column, lo: float, hi: float, bins: int) -> Column:
    return F.least(F.greatest(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(0)), F.lit(bins - 1)).cast("bigint")


def node_terms(nodes: DataFrame, means: DataFrame, id_col: str, vec: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Own features and neighbour means, binned, as (row_id, term, cnt) for the count model."""
    own = nodes.select(F.col(id_col).alias("row_id"), F.posexplode(F.col(vec)).alias("dim", "x")).select(
        "row_id", F.concat(F.lit("o"), F.col("dim").cast("string"), F.lit("="), binned(F.col("x").cast("double"), lo, hi, bins).cast("string")).alias("term")
    )
    nb = means.select(
        F.col(id_col).alias("row_id"),
        F.concat(F.lit("n"), F.col("dim").cast("string"), F.lit("="), binned(F.col("mean"), lo, hi, bins).cast("string")).alias("term"),
    )
    return own.unionByName(nb).withColumn("cnt", F.lit(1.0))


def classify_nodes(nodes: DataFrame, edges: DataFrame, id_col: str, vec: str, label: str, lo: float = -0.5, hi: float = 0.5, bins: int = 10,
                   k: int = 1) -> DataFrame:
    """M14 means, F2 bins, then the count model (M4) trained on labelled
    nodes and applied to the nodes whose label is hidden."""
    means = neighbor_features(nodes, edges, id_col, vec)
    terms = node_terms(nodes, means, id_col, vec, lo, hi, bins).persist(StorageLevel.MEMORY_AND_DISK)  # read by the fit and the scoring
    lab = nodes.filter(F.col(label).isNotNull()).select(F.col(id_col).alias("row_id"), F.col(label).cast("string").alias("label"))
    model = cl._fit(terms.join(lab.select("row_id"), "row_id", "left_semi"), lab, 1.0)
    todo = nodes.filter(F.col(label).isNull()).select(F.col(id_col).alias("row_id"))
    return cl.predict_terms(model, terms.join(todo, "row_id", "left_semi"), todo, k)
