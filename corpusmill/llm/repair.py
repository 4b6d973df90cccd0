"""Conversation structure repair by a persistent audit DP.

Rows of a conversation are kept, given the other role, deleted or joined by inserted
turns, at least cost, until the initials of the roles read ``(s?(ua)+)?``; of equally
cheap audits (the edits' initials in order) the ASCII-least one counts.

The DP runs over the rows with one best audit per state.  Audits are linked nodes, one
per edit, that share their prefixes; a node holds its depth, the rolling hash of its
audit and its ancestors 1, 2, 4, ... edits back.  Ties compare by a search for the longest
common prefix over these ancestors; the prefix found is read until both ways meet in one
node, so that a collision of hashes is noticed and the audits are then read whole.

Two audits of equal cost for the same rows are never prefixes of each other (they would
differ by inserts, which cost), so the lesser one stays the lesser whatever follows.
That lets a conversation be cut: each piece of PIECE rows gives its best audit from every
state to every state, and a second, short DP joins the pieces.  A conversation of a third of
all rows is so many pieces; only its audit, which the result holds in one row, and its
hash, which reads the repaired rows as they pass, belong to one task.

Nulls count as one space, also in the damage's CRC; a null conv_id is one conversation.
Rows of one turn (or none) are ordered by role, then text.  Empty texts are blank; an
empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, by_group, materialise
from corpusmill.operators.ordered import dense_ids

PIECE = 1024
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
# States: nothing yet, after system, after user, after assistant; the first and last end.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_GIVEN = (USER, USER, ASSISTANT, USER)  # state after a turn of the role that fits
BLANKS = " \t\n\x0b\x0c\r"


class Node:
    """An audit: the edit and the way back to the others."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: "Node | None", letter: str, modulus: int) -> None:
        self.letter = letter
        self.depth = parent.depth + 1 if parent else 0
        self.hash = (parent.hash * 911382323 + ord(letter)) % modulus if parent else 0
        self.up: list[Node] = []
        k, at = 0, parent
        while at is not None:
            self.up.append(at)
            at = at.up[k] if k < len(at.up) else None
            k += 1

    def back(self, depth: int) -> "Node":
        """The ancestor at ``depth``."""
        at, far = self, self.depth - depth
        while far:
            k = far.bit_length() - 1
            at, far = at.up[k], far - (1 << k)
        return at

    def audit(self) -> str:
        out, at = [], self
        while at.up:
            out.append(at.letter)
            at = at.up[0]
        return "".join(reversed(out))


def _same(a: Node, b: Node) -> bool:
    """Whether two audits of equal depth are equal, read until they share a node."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def common_prefix(a: Node, b: Node) -> int:
    depth = min(a.depth, b.depth)
    x, y = a.back(depth), b.back(depth)
    if x.hash != y.hash:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        depth = x.depth - 1
        x, y = x.up[0], y.up[0]
    if _same(x, y):
        return depth
    one, two = a.audit(), b.audit()  # hashes collided
    return next(i for i in range(depth + 1) if i == depth or one[i] != two[i])


def lesser(a: Node, x: str, b: Node, y: str) -> bool:
    """Whether audit ``a`` followed by ``x`` comes before ``b`` followed by ``y``."""
    if a is b:
        return x < y
    n = common_prefix(a, b)
    one = a.back(n + 1).letter if a.depth > n else x
    two = b.back(n + 1).letter if b.depth > n else y
    return one < two if one != two else a.depth < b.depth


class Best:
    """The best audit per state."""

    def __init__(self, modulus: int) -> None:
        self.found: list[tuple[int, Node, str] | None] = [None] * 4
        self.modulus = modulus

    def offer(self, state: int, cost: int, before: Node, letter: str) -> None:
        old = self.found[state]
        if old is None or cost < old[0] or cost == old[0] and lesser(before, letter, old[1], old[2]):
            self.found[state] = (cost, before, letter)

    def nodes(self) -> list[tuple[int, Node] | None]:
        """A new node per state; letters are "" where the node itself is offered."""
        return [f and (f[0], Node(f[1], f[2], self.modulus) if f[2] else f[1]) for f in self.found]


def _inserts(at: list, modulus: int) -> list:
    """Adds inserted turns; two in a row may pay, a third leads back to a state."""
    for _ in range(2):
        best = Best(modulus)
        for state, found in enumerate(at):
            if found:
                best.offer(state, found[0], found[1], "")
        for state, found in enumerate(at):
            if found:
                target, cost = _GIVEN[state], found[0] + COST[INSERT]
                if not at[target] or cost < at[target][0] or cost == at[target][0] and lesser(found[1], INSERT, at[target][1], ""):
                    best.offer(target, cost, found[1], INSERT)
        at = best.nodes()
    return at


def audits(initials: Sequence[str], gone: Sequence[bool], cut: Sequence[bool], start: int = START, modulus: int = (1 << 61) - 1) -> list:
    """Per state the least cost and the audit that lead there from ``start``, or None.
    ``gone``: rows to be deleted; ``cut``: truncated rows."""
    at: list = [None] * 4
    at[start] = (0, Node(None, "", modulus))
    at = _inserts(at, modulus)
    for initial, lost, short in zip(initials, gone, cut):
        best = Best(modulus)
        for state, found in enumerate(at):
            if not found:
                continue
            cost, node = found
            best.offer(state, cost + COST[DELETE], node, DELETE)
            if not lost:
                more = cost + TRUNCATED * short
                if (state, initial) in _KEPT:
                    best.offer(_KEPT[state, initial], more + COST[KEEP], node, KEEP)
                best.offer(_GIVEN[state], more + COST[REROLE], node, REROLE)
        at = _inserts(best.nodes(), modulus)
    return [f and (f[0], f[1].audit()) for f in at]


def joined(pieces: Sequence[list[list]]) -> tuple[int, str]:
    """Cost and audit of a conversation from its pieces: per entered state, per left
    state, (cost, audit) or None."""
    at: list = [(0, ("",)), None, None, None]
    for piece in pieces:
        after: list = [None] * 4
        for state, found in enumerate(at):
            for target, step in enumerate(piece[state] if found else ()):
                if step:
                    new = (found[0] + step[0], (*found[1], step[1]) if len(found[1]) < 64 else ("".join(found[1]), step[1]))
                    old = after[target]
                    if old is None or new[0] < old[0] or new[0] == old[0] and "".join(new[1]) < "".join(old[1]):
                        after[target] = new
        at = after
    cost, audit = min((found[0], "".join(found[1])) for found in (at[s] for s in FINAL) if found)
    return cost, audit


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that each row's CRC names."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "fate")
    copies = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.select("conv_id", "turn", "role", "text", F.explode(copies).alias("_copy")).drop("_copy")


def _key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the whole order, and per conversation its first place."""
    keyed = rows.select(_key(F.col("conv_id")).alias("key"), "turn", "role", "text")
    placed = dense_ids(keyed, ["key", "turn", "role", "text"], "place")
    return placed, materialise(placed.groupBy("key").agg(F.min("place").alias("conv")))


def _faults(rows: DataFrame) -> DataFrame:
    """conv, piece, place, turn, initial, blank, duplicate, truncated."""
    shown = F.rtrim("text", F.lit(BLANKS))
    seen = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    facts = rows.select(
        "conv", F.floor((F.col("place") - F.col("conv")) / PIECE).alias("piece"), "place", F.col("turn").cast("long").alias("turn"),
        F.substring("role", 1, 1).alias("initial"), (shown == "").alias("blank"), seen.alias("seen"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("unended"),
    )
    facts = materialise(facts)
    first = facts.groupBy("conv", "seen").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    facts = facts.join(first, "place", "left")
    again = ~F.col("blank") & F.col("first").isNull()
    return facts.select("conv", "piece", "place", "turn", "initial", "blank", again.alias("duplicate"), (~F.col("blank") & ~again & F.col("unended")).alias("truncated"))


_PIECE = (
    "conv long, piece long, least long, most long, turns long, first_turn long, last_turn long, blank long, duplicate long, "
    "truncated long, illegal long, first_initial string, last_initial string, costs array<long>, audits array<string>"
)
_NAMES = [part.split()[0] for part in _PIECE.split(", ")]


def _illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


def _piece_facts(facts: DataFrame) -> DataFrame:
    """Per piece its counts, its ends and its best audits between all states (a first
    piece: from the start)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, 2):
            conv, piece = t.column(0).to_numpy(), t.column(1).to_numpy()
            cols = {c: t.column(c).to_pylist() for c in ("turn", "initial", "blank", "duplicate", "truncated")}
            cut = (np.flatnonzero((conv[1:] != conv[:-1]) | (piece[1:] != piece[:-1])) + 1).tolist()
            out = []
            for lo, hi in zip([0, *cut], [*cut, len(conv)]):
                own = {c: v[lo:hi] for c, v in cols.items()}
                turns = [x for x in own["turn"] if x is not None]
                gone = [a or b for a, b in zip(own["blank"], own["duplicate"])]
                found = [f for s in ((START,) if piece[lo] == 0 else range(4)) for f in audits(own["initial"], gone, own["truncated"], s)]
                out.append((
                    int(conv[lo]), int(piece[lo]), min(turns, default=None), max(turns, default=None), len(set(turns)), own["turn"][0], own["turn"][-1],
                    sum(own["blank"]), sum(own["duplicate"]), sum(own["truncated"]), sum(map(_illegal, own["initial"], own["initial"][1:])),
                    own["initial"][0], own["initial"][-1], [f and f[0] for f in found], [f and f[1] for f in found],
                ))
            kinds = [pa.int64()] * 11 + [pa.string()] * 2 + [pa.list_(pa.int64()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], _NAMES)

    rows = facts.select("conv", "piece", "place", "turn", "initial", "blank", "duplicate", "truncated")
    return rows.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "place").mapInArrow(task, _PIECE)


_CONV = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _conversations(pieces: DataFrame) -> DataFrame:
    """Joins the pieces of each conversation."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, 1):
            out, group = [], []
            for row in [*t.to_pylist(), None]:
                if group and (row is None or row["conv"] != group[0]["conv"]):
                    turns = [(p["least"], p["most"]) for p in group if p["least"] is not None]
                    ends = list(zip(group, group[1:]))
                    # a turn that goes on in the next piece was counted in both
                    distinct = sum(p["turns"] for p in group) - sum(a["last_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in ends)
                    gaps = max(m for _, m in turns) - min(m for m, _ in turns) + 1 - distinct if turns else 0
                    sums = [sum(p[c] for p in group) for c in ("blank", "duplicate", "truncated", "illegal")]
                    sums[3] += sum(_illegal(a["last_initial"], b["first_initial"]) for a, b in ends)
                    steps = [[c if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])] for p in group]
                    out.append((group[0]["conv"], gaps, *sums, *joined([[s[i : i + 4] for i in range(0, len(s), 4)] for s in steps])))
                    group = []
                if row:
                    group.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [part.split()[0] for part in _CONV.split(", ")])

    return pieces.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(task, _CONV)


class Writer:
    """Hashes a repaired conversation row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.empty = audit, 0, START, hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def _given(self, text: str) -> None:
        self.state = _GIVEN[self.state]
        self._line("user" if self.state == USER else "assistant", text)

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            self._given("")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == KEEP:
            self.state = _KEPT[self.state, role[:1]]
            self._line(role, text)
        elif edit == REROLE:
            self._given(text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def _hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, repaired_sha256: the rows pass in order behind their audit."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, writer = None, None
        for b in batches:
            out = []
            for key, place, role, text, audit in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if place < 0:
                    if writer:
                        out.append((conv, writer.digest()))
                    conv, writer = key, Writer(audit)
                else:
                    writer.row(role, text)
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())], ["conv", "repaired_sha256"])
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([writer.digest()], pa.string())], ["conv", "repaired_sha256"])

    heads = found.select("conv", F.lit(-1).cast("long").alias("place"), "audit")
    both = rows.select("conv", "place", "role", "text").unionByName(heads, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(task, "conv long, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256:
    one row per conversation of the input, each damaged first."""
    rows, convs = _placed(damage(conversations))
    rows = materialise(attach(rows, convs, ["key"], ["place"], 16).select("conv", "place", "turn", "role", "text"))
    found = materialise(_conversations(_piece_facts(_faults(rows))))
    whole = found.join(_hashes(rows, found), "conv").join(convs, "conv").drop("conv")
    every = conversations.select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return every.join(whole, "key", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
