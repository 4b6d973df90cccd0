"""Personal data: regular expressions propose spans, checksums confirm them and
nearby context words adjust the score.

Everything is a built-in expression over the row.  Spark gives the texts of all
matches (``regexp_extract_all``) and the texts between them (``split``); adding up
both lengths gives each match's place.  The patterns are possessive and start only
at the head of a run, so that they take linear time and no stack on very long
runs; they find the same leftmost, non-overlapping matches as the plain patterns.

Spans count code points, end exclusive.  Null and empty texts have no spans;
repeated rows are searched each by itself; extra columns are ignored unless named
in ``keep``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import text_of

SPAN = "array<struct<kind:string,ord:int,start:int,end:int,score:double>>"
FOUND = "array<struct<s:int,e:int,m:string>>"
CONTEXT = 48


class Kind(NamedTuple):
    """``hint``: a cheap test that every text with a match passes.  A span counts
    when ``prior`` + ``checked`` (confirmed by ``check``) + 0.3 (a context word
    within CONTEXT characters before it) reaches the caller's threshold."""

    name: str
    hint: str
    pattern: str
    check: str | None
    prior: float
    checked: float
    context: str


_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = (
    Kind("email", "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", None, 0.9, 0.0, r"e-?mail|contact|write"),
    Kind("ip", r"\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "ip", 0.5, 0.2, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9][0-9 -]{12}", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])", "luhn", 0.3, 0.4, r"card|credit|visa|master"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "phone", 0.6, 0.1, r"phone|tel|call|mobile"),
)
# Spans beside the base ones: account numbers with a mod-97 check, and social
# security numbers, which have no checksum and so need a context word.
ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "mod97", 0.2, 0.5, r"iban|account|konto|compte|cuenta"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None, 0.3, 0.0, r"\bssn\b|social security"),
)
THRESHOLD = 0.6


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digits pass the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc
        + F.transform(
            F.array(F.coalesce(F.substring(digits, n - i + 1, F.lit(1)).try_cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1)),
            lambda v: F.when(v > 9, v - 9).otherwise(v),
        )[0],
    )
    return total % 10 == 0


def mod97(m: Column) -> Column:
    """True where an account number passes the mod-97 check."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    # a digit counts as itself, A to Z as 10 to 35
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(F.length(c) == 0, acc).otherwise(step(acc, c))) == 1


def _confirmed(check: str | None, m: Column) -> Column:
    if check == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$")
    if check == "luhn":
        return luhn(_digits(m))
    if check == "phone":
        return F.length(_digits(m)).between(10, 15)
    if check == "mod97":
        return mod97(m)
    return F.lit(True)


def _found(text: Column, kind: Kind) -> Column:
    """(start, end, match) of all matches."""
    pieces = F.array(F.struct(F.split(text, kind.pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit")))

    def place(p: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            hit = F.get(p["hit"], i)
            s = acc["at"] + F.length(F.get(p["gap"], i))
            return F.transform(
                F.array(F.struct(s.alias("s"), (s + F.length(hit)).alias("e"), hit.alias("m"))),
                lambda f: F.struct(f["e"].alias("at"), F.concat(acc["out"], F.array(f)).alias("out")),
            )[0]

        index = F.when(F.size(p["hit"]) > 0, F.sequence(F.lit(0), F.size(p["hit"]) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(index, zero, step)["out"]

    return F.when(text.rlike(kind.hint), F.transform(pieces, place)[0]).otherwise(F.array().cast(FOUND))


def _scored(text: Column, found: Column, kind: Kind, order: int, always: bool, threshold: float) -> Column:
    """Confirmed spans with their score; base kinds stay whatever the score."""

    def near(f: Column) -> Column:
        start = F.greatest(f["s"] - CONTEXT, F.lit(0))
        return F.lower(F.substring(text, start + 1, f["s"] - start)).rlike(kind.context)

    spans = F.transform(
        F.filter(found, lambda f: _confirmed(kind.check, f["m"])),
        lambda f: F.struct(
            F.lit(kind.name).alias("kind"), F.lit(order).alias("ord"), f["s"].alias("start"), f["e"].alias("end"),
            (F.lit(kind.prior + (kind.checked if kind.check else 0.0)) + F.when(near(f), 0.3).otherwise(0.0)).alias("score"),
        ),
    ).cast(SPAN)
    return spans if always else F.filter(spans, lambda x: x["score"] >= threshold)


def find(
    docs: DataFrame, base: Sequence[Kind] = BASE, added: Sequence[Kind] = ADDED, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, ``base_spans`` and ``spans`` (base and added), each an array of
    (kind, ord, start, end, score) by start, then kind as listed."""
    t, kinds = F.col("_t"), [*base, *added]
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, text_of(text_col).alias("_t"))
    rows = rows.select("*", *[_found(t, k).alias(f"_f{i}") for i, k in enumerate(kinds)])
    rows = rows.select(
        "doc_id", *keep, *[_scored(t, F.col(f"_f{i}"), k, i, i < len(base), threshold).alias(f"_s{i}") for i, k in enumerate(kinds)]
    )

    def ordered(n: int) -> Column:
        every = F.concat(*[F.col(f"_s{i}") for i in range(n)])
        turned = F.transform(every, lambda x: F.struct(x["start"], x["ord"], x["end"], x["kind"], x["score"]))
        return F.transform(F.sort_array(turned), lambda x: F.struct(x["kind"], x["ord"], x["start"], x["end"], x["score"]))

    return rows.select("doc_id", *keep, ordered(len(base)).alias("base_spans"), ordered(len(kinds)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
