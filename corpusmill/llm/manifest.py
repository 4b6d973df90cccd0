"""Merkle dataset manifest on a tree of SHA-256 midstates.

A document's leaf is the digest of its fields, each ``-`` for null or its UTF-8 byte
count, ``:`` and value.  Per group (language) leaves ascend by id; while several nodes
remain, every FAN consecutive ones become the digest of their joined hex digests.  The
groups' roots, null group first, then bytewise, give the root of the set in the same way.

Trees grow in tiers of ``levels`` levels: FAN ** levels consecutive nodes are one piece
of work, so that a group of a third of all rows is cut into as many pieces as it needs, and
tier follows tier until each group has one node.  On the way down each node learns its
path: per level the joined digests to its left and to its right.  Where a parent is
rebuilt, it retains a copy of its hash state before each child slot.  Folding a leaf resumes
the state of its slot with the replacement and the right siblings only, level by level.

A null id counts as empty text where its CRC is taken and comes first; rows of equal id
are ordered by their leaf; repeated rows are leaves of their own; extra columns are
ignored; an empty table gives no rows.  Without siblings the proof is the digest of
nothing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, by_group, lower_ascii, materialise
from corpusmill.operators.ordered import dense_ids

FAN, LEVELS = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


class Level:
    """The parents of a row of nodes, with the hash state before each child slot."""

    def __init__(self, nodes: list[bytes]) -> None:
        self.states, self.left, self.right, self.digests = [], [], [], []
        for i in range(0, len(nodes), FAN):
            run = nodes[i : i + FAN]
            joined, h = b"".join(run), hashlib.sha256()
            end = 0
            for child in run:
                self.states.append(h.copy())
                self.left.append(joined[:end])
                end += len(child)
                self.right.append(joined[end:])
                h.update(child)
            self.digests.append(h.hexdigest().encode())


def levels_of(nodes: list[bytes], n: int, levels: int) -> list[Level]:
    """The levels above a piece of a tier of ``n`` nodes."""
    out: list[Level] = []
    for _ in range(min(levels, depth(n))):
        out.append(Level(out[-1].digests if out else nodes))
    return out


class Path:
    """The way from a piece's top to the root, with the states before its slots."""

    def __init__(self, steps: list[dict]) -> None:
        self.steps = [(s["left"].encode(), s["right"].encode()) for s in steps]
        self.states = [hashlib.sha256(left) for left, _ in self.steps]


def fold(levels: list[Level], path: Path, at: int, replacement: bytes) -> bytes:
    """The root with node ``at`` replaced."""
    for level in levels:
        h = level.states[at].copy()
        h.update(replacement)
        h.update(level.right[at])
        replacement, at = h.hexdigest().encode(), at // FAN
    for state, (_, right) in zip(path.states, path.steps):
        h = state.copy()
        h.update(replacement)
        h.update(right)
        replacement = h.hexdigest().encode()
    return replacement


def proof(levels: list[Level], path: Path, at: int) -> str:
    """The digest of all siblings, level by level, left to right."""
    h = hashlib.sha256()
    for level in levels:
        h.update(level.left[at])
        h.update(level.right[at])
        at //= FAN
    for left, right in path.steps:
        h.update(left)
        h.update(right)
    return h.hexdigest()


def leaf(columns: Sequence[Column]) -> Column:
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """key, doc_id, digest, changed: the leaf and, where 3 divides the id's CRC, the leaf
    of the row with its text in lower case."""
    cols = [F.col(c) for c in FIELDS]
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    changed = leaf([*cols[:-1], lower_ascii(F.col("text").cast("string"))])
    key = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    rows = docs.select(key.alias("key"), "doc_id", leaf(cols).alias("digest"), F.when(hit, changed).alias("changed"))
    return rows.withColumn("changed", F.coalesce("changed", "digest"))


def _pieces(rows: DataFrame) -> DataFrame:
    """Rows of a piece together, in order, its path (at place -1) first."""
    return rows.repartition("tree", "piece").sortWithinPartitions("tree", "piece", "at")


def _each_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for t in by_group(batches, 2):
        tree, piece = t.column(0).to_numpy(), t.column(1).to_numpy()
        cut = np.flatnonzero((tree[1:] != tree[:-1]) | (piece[1:] != piece[:-1])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(tree)]):
            yield t.slice(lo, hi - lo)


def tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """tree, at, n, digest, tier by tier, from ``nodes`` to one node a tree."""
    span = FAN**levels

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for t in _each_piece(batches):
            n, digests = t.column(3)[0].as_py(), [d.encode() for d in t.column(4).to_pylist()]
            above = levels_of(digests, n, levels)
            top = above[-1].digests[0] if above else digests[0]
            out.append((t.column(0)[0].as_py(), t.column(1)[0].as_py(), -(-n // span), top.decode()))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["tree", "at", "n", "digest"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["tree", "at", "n", "digest"])

    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = out[-1].select("tree", F.floor(F.col("at") / span).alias("piece"), "at", "n", "digest")
        out.append(materialise(_pieces(rows).mapInArrow(task, "tree long, at long, n long, digest string")))
    return out


def _down(nodes: DataFrame, above: DataFrame, levels: int, top: bool, leaves: bool) -> DataFrame:
    """Takes the paths of ``above`` (tree, at, path, subroot, root) to ``nodes``.
    ``top``: the nodes are tops themselves.  ``leaves``: folds instead of paths."""
    own = [c for c in nodes.columns if c not in ("tree", "at", "n", "digest")]
    piece = F.col("at") if top else F.floor(F.col("at") / FAN**levels)
    rows = nodes.select("tree", piece.alias("piece"), "at", "n", "digest", *own)
    heads = above.select("tree", F.col("at").alias("piece"), F.lit(-1).cast("long").alias("at"), "path", "subroot", "root")
    rows = _pieces(rows.unionByName(heads, allowMissingColumns=True))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _each_piece(batches):
            if t.num_rows < 2:
                continue
            head, t = t.slice(0, 1).to_pylist()[0], t.slice(1)
            digests, n = [d.encode() for d in t.column("digest").to_pylist()], t.column("n")[0].as_py()
            path, rebuilt = Path(head["path"]), [] if top else levels_of(digests, n, levels)
            if leaves:
                changed = t.column("changed").to_pylist()
                folded = [fold(rebuilt, path, i, c.encode()).decode() for i, c in enumerate(changed)]
                proofs = [proof(rebuilt, path, i) for i in range(len(digests))]
                cols = [t.column("doc_id").combine_chunks(), t.column("digest").combine_chunks(), *[pa.array([head[c]] * len(digests)) for c in ("subroot", "root")], pa.array(proofs), pa.array(folded)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
                continue
            paths = []
            for i in range(len(digests)):
                steps, at = [], i
                for level in rebuilt:
                    steps.append({"left": level.left[at].decode(), "right": level.right[at].decode()})
                    at //= FAN
                paths.append(steps + head["path"])
            kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            cols = [t.column("tree").combine_chunks(), t.column("at").combine_chunks(), pa.array(paths, kind), *[pa.array([head[c]] * len(digests), pa.string()) for c in ("subroot", "root")]]
            yield pa.RecordBatch.from_arrays(cols, ["tree", "at", "path", "subroot", "root"])

    if leaves:
        kind = nodes.schema["doc_id"].dataType.simpleString()
        return rows.mapInArrow(task, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return rows.mapInArrow(task, f"tree long, at long, path {_PATH}, subroot string, root string")


def _paths(tree_tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """From the paths of the tops to those of the pieces of the first tier."""
    paths = tops
    for nodes in tree_tiers[-2:0:-1]:
        paths = materialise(_down(nodes, paths, levels, False, False))
    return paths


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per
    document."""
    leaves = materialise(tampered_leaves(docs))
    rows = dense_ids(leaves, ["key", "doc_id", "digest"], "place")
    trees = materialise(rows.groupBy("key").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("n")))
    rows = attach(rows, trees, ["key"], ["place"], 16)
    rows = materialise(rows.select("tree", (F.col("place") - F.col("tree")).alias("at"), "n", "digest", "doc_id", "changed"))
    groups = tiers(rows, levels)
    subroots = groups[-1].join(trees.select("tree", "key"), "tree").select("key", "digest", F.col("tree").alias("group"))
    order = dense_ids(subroots, ["key"], "at")
    n = order.count()
    order = order.select(F.lit(0).cast("long").alias("tree"), "at", F.lit(n).cast("long").alias("n"), "digest", "group")
    whole = tiers(order, levels)
    nothing = F.array().cast(_PATH)
    root = whole[-1].select("tree", "at", nothing.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    paths = root if len(whole) == 1 else _paths(whole, root, levels)
    named = _down(order.select("tree", "at", "n", "digest"), paths, levels, len(whole) == 1, False).select("at", "path", "root")
    tops = order.select("at", "group", F.col("digest").alias("subroot")).join(named, "at")
    tops = materialise(tops.select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("at"), "path", "subroot", "root"))
    found = _down(rows, tops if len(groups) == 1 else _paths(groups, tops, levels), levels, len(groups) == 1, True)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
