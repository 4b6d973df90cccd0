"""Exact token counts by prefix dynamic programming.

For every prefix of a piece of text the byte-pair encoding of that prefix is given
by its last token and the encoding of what stands before it.  Exactly one token t
that ends at place i fits: the one for which (last token before t, t) is a pair that
the merges leave alone.  So one pass stores, for every prefix, its last token and its
exact token count, and any truncation or budget question reads the stored counts.

A text is cut into units before each space that a word character follows.  The
tokenizer always starts a new piece there, so counts of units add up, and units
are cached per worker.  Special strings count as one token, as the library's
default has them.

Null text counts as empty; an empty text has no tokens; repeated rows are counted
each by itself; extra columns are ignored."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the byte-level split pattern of the vocabulary.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNITS = re.compile(r" (?=\w)")
SPACES = regex.compile(r"\s{2,}")
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7e¡-ɏ]*")
CACHE = 400_000
SHORT = (2, 1)


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a visible Latin-1 byte
    stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts at every prefix, for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_symbols()
        raw = lambda s: bytes(byte[c] for c in s)
        special = {x["content"] for x in spec["added_tokens"] if x["special"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.token = {raw(k): v for k, v in vocab.items()}
        self.text = {v: k for k, v in self.token.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merge = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(merges)}
        # lengths of the tokens that end with three given bytes, longest first, then two and one
        ends: dict[bytes, set[int]] = {}
        for b in self.token:
            if len(b) > 2:
                ends.setdefault(b[-3:], set()).add(len(b))
        self.ends = {b: (*sorted(sizes, reverse=True), *SHORT) for b, sizes in ends.items()}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.pair_ok: dict[tuple[int, int], bool] = {}
        self.piece_totals: dict[str, int] = {}
        self.units: dict[str, int] = {}
        self.old_units: dict[str, int] = {}

    def encode_bytes(self, b: bytes) -> list[int]:
        """Plain merging, lowest rank first; used on the bytes of two tokens."""
        ids = [self.token[b[i : i + 1]] for i in range(len(b))]
        while True:
            ranked = [(self.merge[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
            if not ranked:
                return ids
            (_, new), at = min(ranked)
            ids[at : at + 2] = [new]

    def fits(self, a: int, b: int) -> bool:
        ok = self.pair_ok.get((a, b))
        if ok is None:
            if len(self.pair_ok) > 4 * CACHE:
                self.pair_ok.clear()
            ok = self.pair_ok[a, b] = self.encode_bytes(self.text[a] + self.text[b]) == [a, b]
        return ok

    def counts(self, b: bytes) -> list[int]:
        """Token count of b[:i] for every i, for a piece that is split no further."""
        last, count, token, ends, known = [-1] * (len(b) + 1), [0] * (len(b) + 1), self.token, self.ends, self.pair_ok
        for i in range(1, len(b) + 1):
            for size in ends.get(b[i - 3 : i], SHORT) if i > 2 else SHORT:
                j = i - size
                t = token.get(b[j:i]) if j >= 0 else None
                if t is None:
                    continue
                ok = known.get((last[j], t))  # nothing stands before a token at 0: -1
                if ok is None:
                    ok = self.fits(last[j], t) if j else self.alone(t)
                if ok:
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    def piece_total(self, piece: str) -> int:
        """Cached count at the end of a piece: most pieces occur in many units."""
        n = self.piece_totals.get(piece)
        if n is None:
            n = self.counts(piece.encode())[-1]
            if len(piece) <= 64:
                if len(self.piece_totals) > CACHE:
                    self.piece_totals.clear()
                self.piece_totals[piece] = n
        return n

    def alone(self, t: int) -> bool:
        """True if the token's bytes encode to the token itself."""
        ok = self.pair_ok.get((-1, t))
        if ok is None:
            ok = self.pair_ok[-1, t] = self.encode_bytes(self.text[t]) == [t]
        return ok

    def pieces(self, unit: str) -> list[tuple[int, int]]:
        if PLAIN.fullmatch(unit):
            return [m.span() for m in PIECES.finditer(unit)]
        return [span for _, span in self.splitter.pre_tokenize_str(unit)]

    def by_char(self, piece: str) -> np.ndarray:
        """Token count of piece[:i] for every i, each taken as one piece."""
        counts = self.counts(piece.encode())
        return np.asarray(counts)[np.cumsum([0, *(len(c.encode()) for c in piece)])]

    def unit_table(self, unit: str) -> np.ndarray:
        """Token count of unit[:i] for every i, special strings taken as text."""
        out, base = np.zeros(len(unit) + 1, np.int64), 0
        for s, e in self.pieces(unit):
            at = self.by_char(unit[s:e])
            out[s + 1 : e + 1] = base + at[1:]
            if unit[s:e] in ("'re", "'ve", "'ll"):
                out[s + 2] = base + 2  # a quote and a letter are no contraction yet
            base += int(at[-1])
        for m in SPACES.finditer(unit):  # a prefix that ends in white space has the run so far as one piece
            out[m.start() + 1 : m.end() + 1] = out[m.start()] + self.by_char(m.group())[1:]
        return out

    def unit_count(self, unit: str) -> int:
        if self.special and self.special.search(unit):
            return sum(self.unit_count(x) for x in self.special.split(unit)) + len(self.special.findall(unit))
        return sum(self.piece_total(unit[s:e]) for s, e in self.pieces(unit))

    def totals(self, units: list[str]) -> list[int]:
        """Cached token counts of units.  Two generations bound the cache."""
        new, old, out = self.units, self.old_units, []
        for u in units:
            n = new.get(u)
            if n is None:
                n = old.get(u)
                if n is None:
                    n = self.unit_count(u)
                if len(u) <= 64:
                    new[u] = n
            out.append(n)
        if len(new) > CACHE:
            self.old_units, self.units = new, {}
        return out

    def table(self, text: str) -> np.ndarray:
        """Token count of text[:i] for every i: the stored prefix table."""
        out, base, at = np.zeros(len(text) + 1, np.int64), 0, 0
        parts = self.special.split(text) if self.special else [text]
        marks = self.special.findall(text) if self.special else []
        for k, part in enumerate(parts):
            mark = marks[k] if k < len(marks) else ""
            units = split_units(part) or [""]
            for i, u in enumerate(units):
                # what follows belongs to this unit as long as it starts no other
                more = " " if i + 1 < len(units) else mark[:-1]
                t, skip = self.unit_table(u + more), 2 if i else 1
                out[at + skip : at + len(t)] = base + t[skip:]
                at += len(u)
                base += self.unit_count(u)
            if mark:
                at, base = at + len(mark), base + 1
                out[at] = base
        return out


def split_units(text: str) -> list[str]:
    if not text:
        return []
    first, *rest = UNITS.split(text)
    return ([first] if first else []) + [" " + x for x in rest]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def fit(text: str, units: list[str], sums: np.ndarray, budget: int, c: PrefixCounter) -> int:
    """Length of the longest prefix of the text of at most ``budget`` tokens: the
    unit in which the budget ends is read from its prefix table."""
    if not len(sums) or sums[-1] <= budget:
        return len(text)
    k = int(np.searchsorted(sums, budget, side="right"))
    base = int(sums[k - 1]) if k else 0
    t = base + c.table("".join(units[k : k + 2]))
    return sum(map(len, units[:k])) + int(np.flatnonzero(t <= budget)[-1])


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text", with_table: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (code points of the longest
    prefix of at most ``limit`` tokens) and, on request, ``prefix_counts``: little-
    endian 32-bit token counts at every prefix, one for each code point and one for
    the empty prefix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in batches:
            size, total, fits, tables = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                units = split_units(text)
                sums = np.cumsum(np.fromiter(c.totals(units), np.int64, len(units)))
                size.append(len(text.encode()))
                total.append(int(sums[-1]) if len(sums) else 0)
                fits.append(fit(text, units, sums, limit, c))
                if with_table:
                    tables.append(c.table(text).astype("<i4").tobytes())
            over = [n > limit for n in total]
            cols = [batch.column(0), pa.array(size, pa.int64()), pa.array(total, pa.int64()), pa.array(over, pa.bool_()), pa.array(fits, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            if with_table:
                cols.append(pa.array(tables, pa.binary()))
                names.append("prefix_counts")
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return rows.mapInArrow(task, schema + (", prefix_counts binary" if with_table else ""))
