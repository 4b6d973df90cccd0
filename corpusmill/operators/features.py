"""Typed feature columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import char_grams, stable_hash, tokens, word_ngrams
from corpusmill.operators.ordered import dense_ids
from corpusmill.session import bounded_broadcast


# ---- F1: declared column types ------------------------------------------------

@dataclass(frozen=True)
class Text:
    word_n: int = 1
    char_k: int = 0


@dataclass(frozen=True)
class Categorical:
    n_classes: int | None = None
    type: str = "str"  # "int": the value is the class code
    delimiter: str | None = None


@dataclass(frozen=True)
class Numerical:
    range: tuple[float, float] = (0.0, 1.0)
    bins: int = 10


@dataclass(frozen=True)
class Date:
    pass


@dataclass(frozen=True)
class NodeId:
    pass


@dataclass(frozen=True)
class Neighbors:
    pass


@dataclass(frozen=True)
class TokenTags:
    tags: tuple[str, ...] = ()
    default_tag: str = "O"


@dataclass
class FeatureSpec:
    """Column name -> declared type, plus the target column.  Unlisted columns
    are ignored; a listed column missing from the data is an error."""

    types: dict = field(default_factory=dict)
    target: str | None = None

    def check_columns(self, df: DataFrame) -> None:
        missing = [c for c in list(self.types) + ([self.target] if self.target else []) if c not in df.columns]
        if missing:
            raise ValueError(f"columns declared but missing: {missing}")

    def violation_exprs(self) -> list[Column]:
        out = []
        for name, t in self.types.items():
            c = F.col(name)
            if isinstance(t, Numerical):
                lo, hi = t.range
                v = c.try_cast("double")
                bad = v.isNull() | (v < lo) | (v > hi)
            elif isinstance(t, Categorical) and t.type == "int":
                code = c.try_cast("bigint")
                bad = code.isNull() | (code < 0)
                if t.n_classes is not None:
                    bad = bad | (code >= t.n_classes)
            elif isinstance(t, Date):
                bad = c.cast("string").try_cast("date").isNull()
            else:
                bad = c.isNull()
            out.append(F.sum(bad.cast("bigint")).alias(name))
        return out


def validate(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """one counting pass; (column, violations) per declared column.  A value
    that cannot be read as its declared type is a violation."""
    spec.check_columns(df)
    wide = df.agg(*spec.violation_exprs())
    names = list(spec.types)
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, violations)").select(
        "column_name", F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations")
    )


# ---- F2-F11 -------------------------------------------------------------------

def numerical(col, lo: float, hi: float, bins: int) -> tuple[Column, Column]:
    """(scaled 0..1 after clipping, bin number 0..bins-1)."""
    c = F.col(col) if isinstance(col, str) else col
    clipped = F.least(F.greatest(c.cast("double"), F.lit(float(lo))), F.lit(float(hi)))
    scaled = (clipped - F.lit(float(lo))) / F.lit(float(hi - lo))
    b = F.least(F.floor(scaled * bins), F.lit(bins - 1)).cast("bigint")
    return scaled, b


def categorical_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, code) with codes 0..n-1 in value order; distinct first
    (partial aggregation), then distributed dense ids."""
    values = df.select(F.col(col).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()
    return dense_ids(values, ["value"], "code")


def encode(df: DataFrame, col: str, dictionary: DataFrame, code_col: str | None = None) -> DataFrame:
    """value -> code (unknown values get null)."""
    d = bounded_broadcast(dictionary.select(F.col("value").alias("_v"), F.col("code").alias(code_col or f"{col}_code")))
    return df.join(d, F.col(col).cast("string") == F.col("_v"), "left").drop("_v")


def class_name(df: DataFrame, code_col: str, dictionary: DataFrame, name_col: str = "class_name") -> DataFrame:
    """code -> value."""
    d = bounded_broadcast(dictionary.select(F.col("code").alias("_c"), F.col("value").alias(name_col)))
    return df.join(d, F.col(code_col) == F.col("_c"), "left").drop("_c")


def multi_label(df: DataFrame, id_col: str, col: str, delimiter: str) -> DataFrame:
    """(id, label) rows of a delimited multi-label column, distinct."""
    import re

    return df.select(F.col(id_col), F.explode(F.array_distinct(F.split(F.col(col), re.escape(delimiter)))).alias("label")).filter(
        F.col("label") != ""
    )


def text_features(df: DataFrame, id_col: str, text_col: str, word_n: int = 2, char_k: int = 3) -> DataFrame:
    """(id, feature, n): unigrams 'w:', word n-grams 'n:', character k-grams of tokens 'c:'."""
    t = tokens(text_col)
    feats = F.transform(t, lambda x: F.concat(F.lit("w:"), x))
    if word_n > 1:
        feats = F.concat(feats, F.transform(word_ngrams(t, word_n), lambda x: F.concat(F.lit("n:"), x)))
    if char_k > 0:
        feats = F.concat(feats, F.transform(F.flatten(F.transform(t, lambda x: char_grams(x, char_k))), lambda x: F.concat(F.lit("c:"), x)))
    return (
        df.select(F.col(id_col), F.explode_outer(feats).alias("feature"))
        .filter(F.col("feature").isNotNull())
        .groupBy(id_col, "feature")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def date_parts(col) -> list[Column]:
    """ISO day of week (Monday 1), day of month, ISO week, month."""
    c = F.col(col) if isinstance(col, str) else col
    return [
        ((F.dayofweek(c) + 5) % 7 + 1).cast("bigint").alias("dow"),
        F.dayofmonth(c).cast("bigint").alias("dom"),
        F.weekofyear(c).cast("bigint").alias("week"),
        F.month(c).cast("bigint").alias("month"),
    ]


def hash_features(df: DataFrame, id_col: str, cols, width: int) -> DataFrame:
    """sparse fixed-width vector: (id, bucket, n) from 'col=value' strings."""
    feats = F.array(*[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cols])
    return (
        df.select(F.col(id_col), F.explode(feats).alias("f"))
        .select(id_col, F.pmod(stable_hash(F.col("f")), F.lit(width)).alias("bucket"))
        .groupBy(id_col, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def neighbors(df: DataFrame, node_col: str, nbr_col: str) -> DataFrame:
    """F8: space-separated ids to (src, dst) edges; non-numbers dropped."""
    return (
        df.select(F.col(node_col).cast("bigint").alias("src"), F.explode(F.split(F.trim(F.col(nbr_col)), r"\s+")).alias("_d"))
        .select("src", F.expr("try_cast(_d AS BIGINT)").alias("dst"))
        .filter(F.col("dst").isNotNull())
    )


def cross_columns(df: DataFrame, cols) -> DataFrame:
    """every pair of columns as an extra 'a|b' column named a__b."""
    cols = list(cols)
    extra = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = cols[i], cols[j]
            extra.append(F.concat_ws("|", F.col(a).cast("string"), F.col(b).cast("string")).alias(f"{a}__{b}"))
    return df.select("*", *extra)


def align_tags(df: DataFrame, id_col: str, source: str, target: str, tags, default: str = "O", keep=(), previous: bool = False) -> tuple[DataFrame, DataFrame]:
    """(id, pos, token, tag) for rows whose whitespace tokens and tags line
    up and whose tags are all known; the other rows are returned as rejects.
    ``previous`` adds prev_tag, the tag before it in the row, null for the first."""
    allowed = F.array(*[F.lit(t) for t in list(tags) + [default]])
    s = F.filter(F.split(F.col(source), r"\s+"), lambda x: x != "")
    t = F.filter(F.split(F.col(target), r"\s+"), lambda x: x != "")
    keep = list(keep)
    base = df.select(F.col(id_col), *keep, s.alias("_s"), t.alias("_t"))
    ok = (F.size("_s") == F.size("_t")) & F.forall("_t", lambda x: F.array_contains(allowed, x))
    lists, more = ["_s", "_t"], []
    if previous:
        base = base.withColumn("_p", F.concat(F.array(F.lit(None).cast("string")), F.slice("_t", 1, F.greatest(F.size("_t") - 1, F.lit(0)))))
        lists, more = [*lists, "_p"], [F.col("z._p").alias("prev_tag")]
    # an empty row's list of previous tags holds one null: it has no token
    good = base.filter(ok & (F.size("_s") > 0)).select(id_col, *keep, F.posexplode(F.arrays_zip(*lists)).alias("pos", "z")).select(
        id_col, F.col("pos").cast("bigint"), F.col("z._s").alias("token"), F.col("z._t").alias("tag"), *more, *keep
    )
    bad = base.filter(~ok).select(
        id_col, F.when(F.size("_s") != F.size("_t"), F.lit("length")).otherwise(F.lit("unknown_tag")).alias("reason")
    )
    return good, bad
