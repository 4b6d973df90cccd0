"""Ranking and classification metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.ordered import running_totals


def categorical_accuracy(pred: DataFrame, truth: DataFrame, key: str, pred_col: str, label_col: str) -> DataFrame:
    """Share of rows whose predicted class equals the label (missing prediction = wrong)."""
    j = truth.select(key, label_col).join(pred.select(key, pred_col), key, "left")
    return j.agg(F.round(F.avg(F.coalesce((F.col(pred_col) == F.col(label_col)).cast("double"), F.lit(0.0))), 6).alias("accuracy"))


def precision_at_1(hits: DataFrame, truth: DataFrame, q: str = "query_id", d: str = "doc_id", rank: str = "rank") -> DataFrame:
    """Per query with a truth set, is the rank-1 hit true?  No hit is a miss."""
    top = hits.filter(F.col(rank) == 1).select(q, F.col(d).alias("_top"))
    tq = truth.select(q, d).distinct()
    hit = tq.join(top, q).filter(F.col(d) == F.col("_top")).select(q).distinct().withColumn("_ok", F.lit(1.0))
    per_q = tq.select(q).distinct().join(hit, q, "left")
    return per_q.agg(F.round(F.avg(F.coalesce("_ok", F.lit(0.0))), 6).alias("precision_at_1"))


def recall_at_k(hits: DataFrame, truth: DataFrame, k: int, q: str = "query_id", d: str = "doc_id", rank: str = "rank") -> DataFrame:
    """Mean over truth queries of |truth within the first k| / |truth|."""
    tq = truth.select(q, d).distinct()
    got = hits.filter(F.col(rank) <= k).select(q, d).distinct().withColumn("_g", F.lit(1.0))
    per_q = tq.join(got, [q, d], "left").groupBy(q).agg((F.sum(F.coalesce("_g", F.lit(0.0))) / F.count(F.lit(1))).alias("_r"))
    return per_q.agg(F.round(F.avg("_r"), 6).alias("recall_at_k"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Mann-Whitney area, ties worth one half.

    Group by score first (a combinable aggregate), then take running totals of
    negatives over the distinct scores without a single-partition window."""
    g = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("double").alias("neg"),
    )
    r = running_totals(g, "_s", ["neg"])
    return r.agg(
        F.round(F.sum(F.col("pos") * (F.col("neg_before") + F.lit(0.5) * F.col("neg"))) / (F.sum("pos") * F.sum("neg")), 6).alias(
            "roc_auc"
        )
    )


def log_loss(df: DataFrame, prob_of_truth: str) -> DataFrame:
    """E5: mean cross entropy given the probability assigned to the true class."""
    return df.agg(F.round(F.avg(-F.log(F.greatest(F.col(prob_of_truth), F.lit(1e-15)))), 6).alias("log_loss"))


def token_accuracy(pred: DataFrame, truth: DataFrame, keys, pred_col: str = "tag", truth_col: str = "tag") -> DataFrame:
    """Share of tokens (truth rows) whose predicted tag is right."""
    p = pred.select(*keys, F.col(pred_col).alias("_p"))
    t = truth.select(*keys, F.col(truth_col).alias("_t"))
    j = t.join(p, list(keys), "left")
    return j.agg(F.round(F.avg(F.coalesce((F.col("_p") == F.col("_t")).cast("double"), F.lit(0.0))), 6).alias("token_accuracy"))


def compare(runs: dict[str, DataFrame]) -> DataFrame:
    """One metric table per run, stacked with the run name."""
    out = None
    for name, df in runs.items():
        part = df.select(F.lit(name).alias("run"), *df.columns)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
