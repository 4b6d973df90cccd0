"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic) with their token counts; a
token is a word here, a run of characters other than white space.  Each sweep rakes
the cells' weights to the target share of every source, then of every language, then
of every topic.  Sweeps go on until the largest relative gap of any margin is within
``tolerance``, or, where empty cells leave no weights that meet all targets, until a
sweep no longer makes it smaller; the gap reached is part of the result.  A cell's
ratio of weight to tokens, times one factor for all cells, is the expected number of
copies of each of its documents: the whole part as it is, and one more when a hash of
the id, even over [0, 1), lies below the rest: the same choice on every run.  So the
copies meet the target shares also where a cell has too few tokens, up to
``max_copies`` of a document.  The factor is calibrated so that the documents that
stay at all, each counted once, are expected to hold ``keep_share`` of all tokens.

The target share of a value is its token share to the power of the margin's
``alpha`` (1 keeps the present mix, 0 makes all values equal), scaled to sum 1.

Only DataFrame operations; cells, not documents, go through the sweeps.  Null
sources and languages are a value of their own; null and empty texts have no tokens
and are copied like their cell; equal ids share one draw; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import stable_hash
from corpusmill.llm.common import attach, materialise, text_of, words_of

MARGINS = {"source": 0.5, "lang": 0.7, "topic": 0.9}
KEEP_SHARE = 0.8
TOLERANCE = 1e-3
# A sweep that leaves more than this share of the gap ends the raking.
STALLED = 0.99
# No document is repeated more often: cells with a larger ratio miss their target.
MAX_COPIES = 16
NONE = "(none)"

# Topics by the first pattern that occurs, else "prose".
TOPICS = (
    ("licence", r"(?i)licen[cs]e|copyright"),
    ("contact", r"@|\+[0-9]"),
    ("table", r"\|"),
    ("symbols", r"[#$%&*]{2}"),
)


def topic_of(text: Column, topics: Sequence[tuple[str, str]] = TOPICS) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(n) for c, n in ((source_col, "source"), (lang_col, "lang"))], text_of(text_col).alias("_t"))
    return rows.select("doc_id", "source", "lang", topic_of(F.col("_t")).alias("topic"), F.size(words_of(F.col("_t"))).cast("long").alias("n_tokens"))


def rake(cells: DataFrame, margins: Mapping[str, float], tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``weight``, the cells' tokens raked to the target shares, and ``gap``, the
    largest relative gap of any margin that is left.  ``cells``: the margin columns and
    ``tokens``, all above zero.  One sweep is one job, which cuts the lineage, and one
    aggregate that measures the gap."""
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("weight", F.col("tokens").cast("double")).withColumn("gap", F.lit(0.0))
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for name, alpha in margins.items():
        shares = cells.groupBy(name).agg(F.pow(F.sum("tokens") / F.lit(float(total)), F.lit(float(alpha))).alias(f"target_{name}"))
        norm = shares.agg(F.sum(f"target_{name}")).first()[0]
        out = out.join(shares.withColumn(f"target_{name}", F.col(f"target_{name}") * F.lit(float(total) / norm)), name)
    columns = [*cells.columns, *[f"target_{name}" for name in margins]]
    out, before = materialise(out.select(*columns, "weight")), None
    while True:
        for name in margins:
            factor = out.groupBy(name).agg((F.max(f"target_{name}") / F.sum("weight")).alias("factor"))
            out = out.join(factor, name).select(*columns, (F.col("weight") * F.col("factor")).alias("weight"))
        out = materialise(out)
        target = F.coalesce(*[F.when(F.grouping(name) == 0, F.max(f"target_{name}")) for name in margins])
        sums = out.groupingSets([[F.col(name)] for name in margins], *[F.col(name) for name in margins]).agg(F.sum("weight").alias("now"), target.alias("target"))
        gap = sums.agg(F.max(F.abs(F.col("now") - F.col("target")) / F.col("target"))).first()[0]
        if gap <= tolerance or before is not None and gap >= STALLED * before:
            return out.select(*cells.columns, "weight", F.lit(float(gap)).alias("gap"))
        before = gap


def calibrate(cells: DataFrame, keep_share: float, passes: int = 4, steps: int = 64) -> float:
    """The factor k with sum(tokens * least(1, k * ratio)) = keep_share * all tokens,
    closed in on by grids of candidates, one aggregate each."""
    row = cells.agg(F.sum("tokens").alias("t"), F.min("ratio").alias("lo"), F.max("ratio").alias("hi")).first()
    if not row["t"]:
        return 1.0
    low, high = keep_share / row["hi"] * 0.5, 1.0 / row["lo"]
    if keep_share >= 1:
        return high
    for _ in range(passes):
        grid = [low * (high / low) ** (i / steps) for i in range(steps + 1)]
        sums = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("ratio") * F.lit(k))).alias(f"s{i}") for i, k in enumerate(grid)]).first()
        at = max(i for i in range(steps + 1) if i == 0 or sums[i] <= keep_share * row["t"])
        low, high = grid[at], grid[min(at + 1, steps)]
    return low


def mix(
    docs: DataFrame, margins: Mapping[str, float] = MARGINS, keep_share: float = KEEP_SHARE, max_copies: int = MAX_COPIES,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, ratio (target weight over tokens of the
    cell), probability (to stay at all), kept, copies (0 when not kept), gap (left by
    the raking)."""
    rows = materialise(measured(docs, id_col, text_col, source_col, lang_col))
    key = list(margins)
    cells = materialise(rows.groupBy(*key).agg(F.sum("n_tokens").alias("tokens")))
    raked = rake(cells.where("tokens > 0"), margins)
    raked = materialise(raked.withColumn("ratio", F.col("weight") / F.col("tokens")))
    k = calibrate(raked, keep_share)
    gap = raked.agg(F.max("gap")).first()[0] or 0.0
    cells = cells.join(raked.select(*key, "ratio"), key, "left").select(*key, F.coalesce("ratio", F.lit(1.0)).alias("ratio"))
    out = attach(rows, cells, key, ["doc_id"])
    draw = stable_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE))) / F.lit(float(1 << 60))
    expected = F.least(F.col("ratio") * F.lit(k), F.lit(float(max_copies)))
    out = out.withColumn("probability", F.least(F.lit(1.0), expected))
    copies = (F.floor(expected) + (draw < expected - F.floor(expected)).cast("long")).alias("copies")
    return out.select(
        "doc_id", "source", "lang", "topic", "n_tokens", "ratio", "probability", (draw < F.col("probability")).alias("kept"), copies, F.lit(float(gap)).alias("gap")
    )
