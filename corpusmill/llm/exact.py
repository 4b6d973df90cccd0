"""Exact duplicates by hash aggregation of digest runs in tree rounds.

Rows become (digest, best row, count) records dealt over ``runs`` runs by a hash
of their id.  In each round runs r, r + 1, ... r + fan - 1 are grouped by digest:
a hash aggregation in place of a merge of sorted runs, which keeps, per text, the
row that stays and the number of rows.  After log_fan(runs) rounds one run is left,
still spread over all tasks by digest.  The result travels back down the same
tree, so that a text that holds a third of all rows reaches them in ``runs``
parts.  Two rows are of one text when SHA-256, a second independent 64-bit hash
and the length of the normalised text all agree.

Only DataFrame operations.  Null text counts as empty; a null id sorts after all
others; repeated rows (equal id and text) each come back, all kept or dropped
together; extra columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialise, run_of, text_of

KEY = ("_sha", "_x", "_len")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, code points of the original text, digests of the normalised one."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_t"))
    base = base.select("doc_id", F.length("_t").alias("_chars"), F.regexp_replace("_t", r"[\x20\x09-\x0D]+", "").alias("_norm"))
    return base.select(
        "doc_id", "_chars", F.sha2("_norm", 256).alias("_sha"), F.xxhash64("_norm").alias("_x"), F.octet_length("_norm").alias("_len")
    )


def _merge(runs: DataFrame) -> DataFrame:
    """Merges the records of a run: smallest ``best`` and total count per digest.
    ``best`` orders by most code points, then smallest id, null ids last."""
    return runs.groupBy("_run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 256, fan: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    rows = materialise(digests(docs, id_col, text_col).withColumn("_run", run_of(["doc_id"], runs)))
    best = F.struct((-F.col("_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    level = _merge(rows.select("_run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("n")))
    levels, width = [level], runs
    while width > 1:
        width = -(-width // fan)
        level = _merge(level.withColumn("_run", F.floor(F.col("_run") / fan).cast("int")))
        levels.append(level)
    found = levels.pop()
    while levels:  # down again: a child run takes the result of its parent
        child = levels.pop().select(*KEY, F.col("_run").alias("_child"), F.floor(F.col("_run") / fan).cast("int").alias("_run"))
        found = child.join(found, [*KEY, "_run"]).select(*KEY, F.col("_child").alias("_run"), "best", "n")
    return rows.join(found, [*KEY, "_run"]).select(
        "doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("best.id"))).alias("kept"), F.col("_sha").alias("text_sha256"),
    )
