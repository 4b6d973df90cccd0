"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the row: no shuffle, no Python.
Nulls and empty texts have no words and are rejected; repeated rows are judged
each by itself; extra columns are ignored unless asked for with ``keep``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import fenced, text_of, words_of

WINDOW = 8


class Rule(NamedTuple):
    """Documents whose measure leaves [low, high] are rejected; ``from_words``:
    the rule holds from that many words on, as ratios of short texts say little."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


# Frequent function words of the four languages of the corpus, fixed values.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are an from or not have "
    "le la les de des du et un une en est que qui dans pour par sur au avec pas "
    "der die das und den von zu mit sich ist nicht ein eine im auf dem als auch "
    "el los las del y se por con no una su para es al lo como"
).split()

RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.2),
    Rule("dup_line_ratio", None, 0.5),
    Rule("upper_ratio", None, 0.4),
    Rule("words_with_letter", 0.4, None),
    Rule("stop_word_ratio", 0.02, None, 60),
    Rule("ended_lines", 0.05, None, 60),
)


def _repeat_words(windows: Column, n_windows: Column) -> Column:
    """Words in windows that occur twice or more: sort (hash, place), keep places
    with an equal neighbour, then add up the union of their spans."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # transform over a one-element array binds the sorted array to a name once
    hits = F.transform(
        F.array(placed),
        lambda a: F.filter(
            a,
            lambda x, k: F.coalesce(F.get(a, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(a, k + 1)["h"] == x["h"], F.lit(False)),
        ),
    )[0]
    spans = F.aggregate(
        F.sort_array(F.transform(hits, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
    )["n"]
    return F.when(F.size(F.array_distinct(windows)) == n_windows, F.lit(0)).otherwise(spans)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document with its counts and ratios."""
    base = docs.select(F.col(id_col).alias("doc_id"), *keep, text_of(text_col).alias("_t"))
    base = base.select("*", words_of(F.col("_t")).alias("_w"), F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    base = base.select("*", F.size("_w").alias("_n"), F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"))
    window = F.transform(
        F.sequence(F.lit(0), F.col("_n") - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)])
    )
    base = base.select("*", F.when(F.col("_n") > WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("_v"))
    n, lines, chars = F.col("_n"), F.size("_l"), F.greatest(F.length("_t"), F.lit(1))
    per_word = F.greatest(n, F.lit(1))
    per_line = F.greatest(lines, F.lit(1))
    word_chars = F.length(F.array_join("_w", ""))
    symbols = F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", ""))
    dup = lines - F.size(F.array_distinct("_l"))
    return base.select(
        "doc_id", *keep,
        fenced(n.cast("long")).alias("n_words"),
        word_chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_v"), F.size("_v")).cast("long").alias("n_repeat_words"),
        (word_chars / per_word).alias("mean_word_chars"),
        (symbols / per_word).alias("symbols_per_word"),
        (dup / per_line).alias("dup_line_ratio"),
        (F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")) / chars).alias("upper_ratio"),
        (F.size(F.filter("_w", lambda x: x.rlike(r"\p{L}"))) / per_word).alias("words_with_letter"),
        (F.size(F.filter("_w", lambda x: F.lower(x).isin(STOP_WORDS))) / per_word).alias("stop_word_ratio"),
        (F.size(F.filter("_l", lambda x: x.rlike(r"[\p{P}][\x20\x09-\x0D]*$"))) / per_line).alias("ended_lines"),
    )


def _passes(rules: Sequence[Rule]) -> Column:
    ok = F.lit(True)
    for r in rules:
        m = F.col(r.measure)
        holds = F.lit(True)
        if r.low is not None:
            holds = holds & (m >= r.low)
        if r.high is not None:
            holds = holds & (m <= r.high)
        ok = ok & ((F.col("n_words") < r.from_words) | holds)
    return ok


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = 20, max_repeat_percent: int = 30,
    id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
) -> DataFrame:
    """Measures plus ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    return measure(docs, id_col, text_col, keep).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & _passes(rules))
