"""URL filters: host rules first, then the ratio of two character language models.

URLs that a rule allows or blocks train one smoothed variable-order Markov model
each.  The probability of a character after its context blends orders 0 to ORDER:
p_k = (n(context, c) + w * p_(k-1)) / (n(context) + w), starting from an even spread
over ALPHABET characters.  The score is the difference of both log-likelihoods over
the number of characters, and the threshold lies between the means of the two
training sets, weighted by their spreads.  A URL that no rule fits is allowed when
its score reaches the threshold.

All grams enter the model.  A character's blended probability is a function of the
gram of ORDER + 1 characters that ends in it, so it is worked out once for each
distinct gram, order by order, from tables joined by shuffle; the characters of all
URLs then take it by their gram, a frequent gram's in many parts.

Null or empty URLs, or those without '://', have empty host and path; no rule fits
them, and a URL without characters scores zero.  Without training URLs of both
kinds there is no evidence and everything left is allowed.  Repeated rows are judged
each by itself; extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, lower_ascii, materialise

ORDER, WEIGHT, ALPHABET = 3, 2.0, 128


class UrlRule(NamedTuple):
    """``prefix``: host and path start joined, as in ``net/``; it fits the host and
    all its subdomains."""

    verdict: str
    prefix: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased.
    Path: from there up to '?', '#' or the end."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.substring(url, found + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(found > 0, lower_ascii(host)).otherwise(""), F.when(found > 0, path).otherwise("")


def rule_of(rules: Sequence[UrlRule], host: Column, path: Column) -> Column:
    """(prefix, verdict) of the longest rule that fits, else null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.prefix), r.prefix)):
        name, _, start = r.prefix.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        hit = F.struct(F.lit(r.prefix).alias("prefix"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<prefix:string,verdict:string>")


def grams(rows: DataFrame) -> DataFrame:
    """(row columns, g): per character the gram of ORDER + 1 characters that ends in
    it; URLs are padded in front so that the first characters have contexts too."""
    padded = F.concat(F.lit("^" * ORDER), F.col("text"))
    ends = F.when(F.length("text") > 0, F.sequence(F.lit(1), F.length("text"))).otherwise(F.array().cast("array<int>"))
    at = rows.withColumn("_p", padded).withColumn("_e", F.explode(ends))
    return at.select(*[c for c in rows.columns if c != "text"], F.substr(F.col("_p"), F.col("_e"), F.lit(ORDER + 1)).alias("g"))


def train(rows: DataFrame) -> list[DataFrame]:
    """Per order k a table (g, a, b, ca, cb): how often the gram and its context occur
    in training URLs of both kinds.  ``rows``: text, good (null: not for training, its
    grams come with the counts of the others)."""
    a, b = F.count_if(F.col("good")).alias("a"), F.count_if(~F.col("good")).alias("b")
    counts = materialise(grams(rows.select("text", "good")).groupBy("g").agg(a, b))
    tables = []
    for k in range(ORDER, -1, -1):
        if k < ORDER:
            counts = materialise(counts.groupBy(F.substr(F.col("g"), F.lit(2)).alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
        named = counts.withColumn("c", F.substr(F.col("g"), F.lit(1), F.lit(k)))
        contexts = named.groupBy("c").agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
        tables.insert(0, attach(named, contexts, ["c"], ["g"]).select("g", "a", "b", "ca", "cb"))
    return tables


def likelihoods(tables: list[DataFrame]) -> DataFrame:
    """(g, value): per gram of the highest order the difference of the log-probabilities
    of its last character, the counts of all orders blended."""
    out = None
    for k, t in enumerate(tables):
        if out is None:
            both = t.withColumn("pa", F.lit(1.0 / ALPHABET)).withColumn("pb", F.lit(1.0 / ALPHABET))
        else:
            shorter = out.select(F.col("g").alias("_s"), "pa", "pb")
            both = attach(t.withColumn("_s", F.substr(F.col("g"), F.lit(2))), shorter, ["_s"], ["g"])
        out = materialise(both.select("g", *[((F.col(s) + WEIGHT * F.col(f"p{s}")) / (F.col(f"c{s}") + WEIGHT)).alias(f"p{s}") for s in ("a", "b")]))
    return out.select("g", (F.log("pa") - F.log("pb")).alias("value"))


def scored(rows: DataFrame, values: DataFrame) -> DataFrame:
    """``score`` per row number: mean log-likelihood difference by character.
    ``rows``: number, text."""
    return attach(grams(rows), values, ["g"], ["number"]).groupBy("number").agg(F.avg("value").alias("score"))


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, host, path, rule, score, verdict."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_r", rule_of(rules, F.col("host"), F.col("path")))
    # equal URLs score equally: each distinct one is scored once
    rows = rows.withColumn("key", F.coalesce("url", F.lit("")))
    text = F.regexp_replace("key", "^[^:/?#]*://", "")
    distinct = rows.groupBy("key").agg(F.first("_r.verdict").alias("label")).withColumn("text", text)
    distinct = materialise(distinct.withColumn("number", F.monotonically_increasing_id()))
    marked = distinct.select("text", (F.col("label") == "allow").alias("good"))
    kinds = {r["good"] for r in marked.where("good is not null and length(text) > 0").select("good").distinct().collect()}
    if len(kinds) < 2:
        scores, threshold = distinct.select("key", F.lit(0.0).alias("score")), -math.inf
    else:
        found = scored(distinct.select("number", "text"), likelihoods(train(marked)))
        scores = materialise(distinct.join(found, "number", "left").select("key", "label", F.coalesce("score", F.lit(0.0)).alias("score")))
        spread = scores.where(F.col("label").isNotNull()).groupBy("label").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s"))
        at = {r["label"]: (r["m"], r["s"] + 1e-9) for r in spread.collect()}
        (ma, sa), (mb, sb) = at["allow"], at["block"]
        threshold = (ma * sb + mb * sa) / (sa + sb)
    out = attach(rows, scores.select("key", "score"), ["key"], ["page_id"])
    own = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return out.select("page_id", "url", "host", "path", F.col("_r.prefix").alias("rule"), "score", F.coalesce(F.col("_r.verdict"), own).alias("verdict"))
