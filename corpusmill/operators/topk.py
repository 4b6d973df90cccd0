"""Per-key top-k.

``row_number() over (partition by key order by score desc, id) <= k`` is planned
by Spark 4 as WindowGroupLimit *before* and after the shuffle, so each map task
forwards at most k rows per key: a hot key never brings all its candidates to
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys, order, k: int, rank_col: str = "rank") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k).withColumn(
        rank_col, F.col(rank_col).cast("bigint")
    )


def top_k_by_score(df: DataFrame, keys, score: str, tie: str, k: int, rank_col: str = "rank") -> DataFrame:
    """Highest ``score`` first, ties by ascending ``tie``."""
    return top_k(df, keys, [F.col(score).desc(), F.col(tie).asc()], k, rank_col)
