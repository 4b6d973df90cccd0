"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import ensure_checkpoint_dir

# Fixed value of the contracts: a word is a run of characters outside this class.
SPACE = r"[\x20\x09-\x0D]+"
# Sub-groups that a hot key's rows are dealt over.
RUNS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fenced(column: Column) -> Column:
    """The column itself, but the optimizer moves no filter on it below this point:
    a filter on layered expressions would otherwise spell out every layer again."""
    return F.when(F.monotonically_increasing_id() >= 0, column)


def materialise(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and cuts its lineage, so that
    a lost executor costs a reread and never a second, different evaluation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def run_of(ids: Sequence[str], runs: int = RUNS) -> Column:
    """The sub-group of a row, from its ids: the same on every evaluation."""
    return F.pmod(F.xxhash64(*ids), F.lit(runs)).cast("int")


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], ids: Sequence[str], runs: int = RUNS, tasks: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with one fact row per key, safe for a key that holds
    a third of all rows: the facts go down to (key, run) first, at most ``runs``
    rows per key, and each row then meets the copy of its own run.  Keys must not
    be null.  ``tasks``: as many as the steps of a small table need at most."""
    few = (lambda df: df.coalesce(tasks)) if tasks else (lambda df: df)
    rows = rows.withColumn("_run", run_of(ids, runs))
    heads = few(few(rows.select(*keys, "_run").distinct()).join(facts, list(keys)))
    return few(rows.join(heads, [*keys, "_run"])).drop("_run")


def by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows, which lie together by their first ``keys`` columns, in tables of
    whole groups: the last group of a batch waits for the next one."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        block = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:keys]])
        other = np.any(block != block[-1], axis=1)
        last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if rest and any(rest[-1].column(k)[-1] != b.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(rest)
            rest = []
        if last:
            yield pa.Table.from_batches([*rest, b.slice(0, last)])
            rest = []
        rest.append(b.slice(last))
    if rest:
        yield pa.Table.from_batches(rest)
