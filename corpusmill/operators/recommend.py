"""Next-item recommendation from user history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.ordered import last_k_before
from corpusmill.operators.topk import top_k


def transitions(history: DataFrame, user: str, item: str, order: list[str]) -> DataFrame:
    """Model: (a, b, n) = how often item b directly followed item a in a user's history.

    The previous item comes from the skew-proof ``last_k_before`` (k = 1), so a
    user holding a third of all rows is still cut into bounded groups."""
    prev = last_k_before(history.select(user, item, *[c for c in order if c != item]), user, order, 1, item, out="_prev")
    return (
        prev.filter(F.size("_prev") == 1)
        .groupBy(F.col("_prev")[0].alias("a"), F.col(item).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def latest(history: DataFrame, user: str, order: list[str], k: int) -> DataFrame:
    """The k most recent rows per user (partial per-task limit before the shuffle)."""
    return top_k(history, user, [F.col(c).desc() for c in order], k, "_recent").drop("_recent")


def popular(history: DataFrame, item: str, k: int) -> DataFrame:
    """The k most frequent items (TakeOrderedAndProject)."""
    return (
        history.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("score"))
        .orderBy(F.desc("score"), "item").limit(k)
    )


def recommend(model: DataFrame, history: DataFrame, users: DataFrame, user: str, item: str, order: list[str], k: int, recent: int = 3,
              fallback: DataFrame | None = None) -> DataFrame:
    """score(item) = sum of transition counts from the user's ``recent`` latest
    items; top k per user (ties by item).  Users with no scored item get the
    popular list (M11, k rows)."""
    last = latest(history, user, order, recent).select(F.col(user).alias("user_id"), F.col(item).alias("a"))
    scored = last.join(model, "a").groupBy("user_id", F.col("b").alias("item")).agg(F.sum("n").alias("score"))
    ranked = top_k(scored, "user_id", [F.col("score").desc(), F.col("item").asc()], k).select("user_id", "item", "rank", "score")
    if fallback is None:
        return ranked
    missing = users.select(F.col(user).alias("user_id")).distinct().join(ranked.select("user_id").distinct(), "user_id", "left_anti")
    return ranked.unionByName(_with_popular(missing, fallback))


def _with_popular(users: DataFrame, pop: DataFrame) -> DataFrame:
    """Each listed user gets the popular list; it has k rows, so it is brought
    to the driver and attached as a literal array (no join)."""
    rows = pop.orderBy(F.desc("score"), "item").collect()
    arr = F.array(
        *[F.struct(F.lit(r["item"]).alias("item"), F.lit(i + 1).cast("bigint").alias("rank"), F.lit(r["score"]).alias("score")) for i, r in enumerate(rows)]
    )
    if not rows:
        return users.select("user_id", F.lit(None).cast("bigint").alias("item"), F.lit(None).cast("bigint").alias("rank"),
                            F.lit(None).cast("bigint").alias("score")).limit(0)
    return users.select("user_id", F.explode(arr).alias("_p")).select("user_id", "_p.item", "_p.rank", "_p.score")


def observe(history: DataFrame, rows: DataFrame) -> DataFrame:
    """New observations join the history; the model is unchanged."""
    return history.unionByName(rows)


def reset(history: DataFrame) -> DataFrame:
    """An empty history with the same columns."""
    return history.limit(0)
