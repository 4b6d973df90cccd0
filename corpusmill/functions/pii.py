"""Pattern rules for personal data, in the fixed order they are applied.

Each rule is (kind, pattern, check).  Matches are masked as the rules run, so
a later rule never sees text an earlier rule claimed (a card number is not
also a phone number).  ``check`` names a validity test on the match: Luhn for
cards, mod-97 for IBANs.  Patterns use no look-around or back-references so the
DuckDB oracle can run them unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds, patterns and their order.
RULES = [
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", None),
    ("IBAN", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", "mod97"),
    ("CARD", r"\b(?:[0-9][ -]?){12,18}[0-9]\b", "luhn"),
    ("SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", None),
    ("PHONE", r"(?:\+?[0-9]{1,3} )?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}\b", None),
    ("DATE", r"\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})\b", None),
    ("CARD_CODE", r"\b(?:CVV|CVC|cvv|cvc)[: ]*[0-9]{3,4}\b", None),
    ("PASSPORT", r"\b(?:[Pp]assport)(?: [Nn]o\.?| [Nn]umber)?[: ]*[A-Z0-9]{6,9}\b", None),
    ("DRIVING_LICENCE", r"\b(?:[Dd]riving licen[cs]e|[Dd]river'?s licen[cs]e)(?: [Nn]o\.?| [Nn]umber)?[: ]*[A-Z0-9-]{5,15}\b", None),
    ("NAME", r"\b(?:Mr|Mrs|Ms|Dr)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?", None),
]
KINDS = [k for k, _, _ in RULES] + ["LOCATION"]


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def luhn_ok(c: Column) -> Column:
    """Luhn checksum over the digits of a match (13 to 19 digits)."""
    rev = F.reverse(_digits(c))
    n = F.length(rev)
    total = F.aggregate(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        F.lit(0),
        lambda acc, i: acc
        + F.when(n == 0, F.lit(0)).otherwise(
            F.when(
                i % 2 == 1,
                F.when(F.substr(rev, i + 1, F.lit(1)).cast("int") * 2 > 9, F.substr(rev, i + 1, F.lit(1)).cast("int") * 2 - 9).otherwise(
                    F.substr(rev, i + 1, F.lit(1)).cast("int") * 2
                ),
            ).otherwise(F.substr(rev, i + 1, F.lit(1)).cast("int"))
        ),
    )
    return n.between(13, 19) & (total % 10 == 0)


def mod97_ok(c: Column) -> Column:
    """IBAN check: move the first four characters to the end, letters to 10..35, number mod 97 = 1."""
    s = F.upper(F.regexp_replace(c, " ", ""))
    r = F.concat(F.substr(s, F.lit(5), F.lit(100)), F.substr(s, F.lit(1), F.lit(4)))
    expanded = F.array_join(
        F.transform(F.split(r, ""), lambda ch: F.when(ch.rlike("[0-9]"), ch).otherwise((F.ascii(ch) - 55).cast("string"))), ""
    )
    m = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(expanded), F.lit(1))),
        F.lit(0).cast("bigint"),
        lambda acc, i: (acc * 10 + F.coalesce(F.substr(expanded, i, F.lit(1)).cast("bigint"), F.lit(0))) % 97,
    )
    return m == 1


CHECKS = {"luhn": luhn_ok, "mod97": mod97_ok}
