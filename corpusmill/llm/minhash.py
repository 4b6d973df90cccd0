"""MinHash near-duplicates by tensored banding, with verified candidates.

A document's set is its distinct two-word shingles.  SIDE left and SIDE right
collections of DEPTH minhashes each are worked out, 2 * SIDE * DEPTH hashes in all;
every pair of a left and a right collection is the key of one table, so that
SIDE * SIDE tables of 2 * DEPTH hashes cost about the square root of the hashes that
separate tables would.  Two sets of similarity s share no table with probability
1 - (1 - (1 - s**DEPTH)**SIDE)**2: below 1e-4 at 0.8, below 1e-7 at 0.85.

Rows meet under their left key only, with the right collections beside them; a group
is then told apart by each right collection in turn.  A left key of more than GROUP
rows is dealt out by (left, right) key instead, so that no group grows with the data.

A table entry of two or three sets gives all its pairs.  A larger one gives the pairs
of its smallest set, the centre, and all the entries of one centre form a group.  Pairs
that pass the bounds (sizes, agreeing collections) are checked on the whole sets.
Components of these links come next; a group whose members lie in one component is
done, in the others every two members of different components are compared, block
by block.  So each pair that shares a table is linked, checked or already connected.

Equal sets are one node; a node is the hash of its set.  Null and empty texts have an
empty set and link with nothing.  A null id is nobody's smallest id; repeated rows
each come back; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, by_group, materialise
from corpusmill.llm.simhash import components

# Minhashes in a collection; collections on each side of a table key.
DEPTH, SIDE = 3, 14
# Of 2 * SIDE collections, 14 agree on average at similarity 0.8; fewer than this do
# with probability 1e-6.
AGREE = 4
# Rows of a left group; members and shingles of a block; words whose hash a task keeps.
GROUP, BLOCK, BLOCK_SHINGLES, WORDS = 4096, 512, 1 << 22, 1 << 18

_rng = np.random.default_rng(12)
_A = _rng.integers(1, 1 << 63, 2 * SIDE * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, 2 * SIDE * DEPTH, dtype=np.uint64)
_C = _rng.integers(1, 1 << 63, (2, DEPTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sets of hashed shingles; keeps the hashes of words it met."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """The ascending 64-bit hashes of the distinct shingles.  Distinct shingles are
        told apart by their words, not by hash."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        place: dict[bytes, int] = {}
        at = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
        if len(self.known) > WORDS:
            self.known.clear()
        known, hashes = self.known, np.empty(len(place), np.uint64)
        for w, i in place.items():
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            hashes[i] = h
        if len(words) == 1:
            return _mix(hashes)
        pair = np.unique(at[:-1] * len(place) + at[1:])
        one, two = hashes[pair // len(place)], hashes[pair % len(place)]
        return np.sort(_mix(_mix(one) * np.uint64(3) + two))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):  # a very long text is met in parts
        np.minimum(out, (shingles[i : i + 2048, None] * _A + _B).min(axis=0), out=out)
    return out


def collections(shingles: np.ndarray) -> np.ndarray:
    """2 x SIDE keys, left and right, of DEPTH minhashes each."""
    m = minhashes(shingles).reshape(2, SIDE, DEPTH)
    return _mix((_mix(m) * _C[:, None, :]).sum(axis=2, dtype=np.uint64))


def _node(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 12)).astype(np.int64)))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("row", F.xxhash64("doc_id", "text"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n, node, lefts, rights; the last two are null below four shingles,
    where no other set is similar enough, node is null for an empty set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            n, node, left, right = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingler.shingles(text)
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
                keys = collections(s).view(np.int64) if len(s) > 3 else None
                left.append(None if keys is None else keys[0])
                right.append(None if keys is None else keys[1])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(left, kind), pa.array(right, kind)],
                ["doc_id", "row", "n", "node", "lefts", "rights"],
            )

    rows = _source(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, row long, n long, node long, lefts array<long>, rights array<long>")


def entry_pairs(group: np.ndarray, node: np.ndarray, n: np.ndarray, rights: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, crowded, sized) of the table entries within the groups, distinct."""
    found = []
    for j in range(rights.shape[1]):
        order = np.lexsort((node, rights[:, j], group))
        g, r = group[order], rights[order, j]
        start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (r[1:] != r[:-1])]))
        length = np.diff(np.concatenate([start, [len(g)]]))
        many = np.repeat(length, length)
        centre = np.repeat(start, length)
        place = np.arange(len(g))
        x = np.flatnonzero((many > 1) & (place > centre))
        a, b, crowded = centre[x], x, many[x] > 3
        three = start[length == 3]
        a, b = np.concatenate([a, three + 1]), np.concatenate([b, three + 2])
        crowded = np.concatenate([crowded, np.zeros(len(three), bool)])
        found.append(np.column_stack([order[a], order[b], crowded]))
    pairs = np.unique(np.concatenate(found), axis=0)
    a, b = pairs[:, 0], pairs[:, 1]
    sized = 100 * np.minimum(n[a], n[b]) >= 80 * np.maximum(n[a], n[b])
    wanted = sized | (pairs[:, 2] == 1)
    return node[a][wanted], node[b][wanted], pairs[:, 2][wanted] == 1, sized[wanted]


def _sized(a: Column, b: Column, share: int) -> Column:
    return 100 * F.least(a, b) >= share * F.greatest(a, b)


def candidates(sets: DataFrame) -> DataFrame:
    """(a, b, crowded, sized): the pairs of the table entries, distinct.  ``sets`` has
    distinct nodes with their lefts and rights."""
    lefts = sets.select("node", "n", "rights", F.posexplode("lefts").alias("_i", "_l"))
    lefts = lefts.select(F.xxhash64("_i", "_l").alias("key"), "node", "n", "rights")
    met = materialise(lefts.select("key").groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, 1):
            t = t.combine_chunks()
            key, node, n = (t.column(i).to_numpy() for i in range(3))
            group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rights = t.column(3).chunk(0).flatten().to_numpy().reshape(len(key), -1)
            a, b, crowded, sized = entry_pairs(group, node, n, rights)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(crowded), pa.array(sized)], ["a", "b", "crowded", "sized"])

    few = lefts.join(met.where(F.col("met") <= GROUP), "key").select("key", "node", "n", "rights")
    pairs = few.repartition("key").sortWithinPartitions("key").mapInArrow(task, "a long, b long, crowded boolean, sized boolean")
    many = met.where(F.col("met") > GROUP)
    if many.limit(1).count():
        cells = attach(lefts, many, ["key"], ["node"]).select("key", "node", "n", F.posexplode("rights").alias("_j", "_r"))
        cells = cells.select(F.xxhash64("key", "_j", "_r").alias("cell"), "node", "n")
        centre = cells.groupBy("cell").agg(F.min("node").alias("a"), F.min_by("n", "node").alias("m"), F.count(F.lit(1)).alias("met"))
        dealt = attach(cells, centre.where("met > 1"), ["cell"], ["node"]).where("node <> a")
        pairs = pairs.unionByName(dealt.select("a", F.col("node").alias("b"), (F.col("met") > 2).alias("crowded"), _sized(F.col("n"), F.col("m"), 80).alias("sized")))
    return pairs.groupBy("a", "b").agg(F.max("crowded").alias("crowded"), F.max("sized").alias("sized"))


def similar(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    """100 * intersection >= share * union, of two ascending sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs whose whole sets are similar.  A centre with many pairs meets its set
    by run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = b.column(2), b.column(3)
            good = [similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), share) for x, y in zip(one, two)]
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = attach(pairs.select("a", "b"), sets.select(F.col("node").alias("a"), F.col("set").alias("one")), ["a"], ["b"], 16)
    both = one.join(sets.select(F.col("node").alias("b"), F.col("set").alias("two")), "b").select("a", "b", "one", "two")
    return both.mapInArrow(task, "a long, b long")


def cross_links(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """Links between members of different components.  Of two components one is not
    the largest, so only members outside the largest are looked up."""
    size = np.array([len(s) for s in sets])
    flat, where = np.unique(np.concatenate(sets), return_inverse=True)
    end = np.cumsum(size)
    start = end - size
    names, count = np.unique(labels, return_counts=True)
    label = np.searchsorted(names, labels)
    out, seen = [], np.zeros(len(flat), bool)
    for x in np.flatnonzero(label != np.argmax(count)):
        seen[where[start[x] : end[x]]] = True
        both = np.add.reduceat(seen[where], start, dtype=np.int64)
        seen[where[start[x] : end[x]]] = False
        close = (100 * both >= share * (size + size[x] - both)) & (label != label[x])
        one, at = np.unique(label[close], return_index=True)
        for y, other in zip(np.flatnonzero(close)[at], one):  # one link to each component
            out.append((int(nodes[x]), int(nodes[y])))
            label[label == other] = label[x]
    return out


def _across(crowded: DataFrame, links: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The links within the groups of one centre that the links so far leave apart."""
    named = components(links)
    members = crowded.select(F.col("a").alias("c"), F.col("b").alias("node"))
    members = members.unionByName(crowded.select(F.col("a").alias("c"), F.col("a").alias("node")).distinct())
    members = members.join(named, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    members = members.join(sets.select("node", "n"), "node")
    groups = members.groupBy("c").agg(
        F.count(F.lit(1)).alias("met"), F.sum("n").alias("total"), F.min("label").alias("least"), F.max("label").alias("most")
    )
    blocks = F.ceil(F.greatest(F.col("met") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    open_groups = groups.where("met > 2 and least <> most").select("c", blocks.alias("blocks"))
    dealt = attach(members, open_groups, ["c"], ["node"], 16).withColumn("i", F.pmod(F.xxhash64("node", "c"), F.col("blocks")).cast("int"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("i")))
    dealt = dealt.withColumn("j", F.explode(others))
    dealt = dealt.select("c", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "node", "label").join(sets.select("node", "set"), "node")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, 3):
            c, i, j, node, label = (t.column(k).to_numpy() for k in range(5))
            cut = np.flatnonzero((c[1:] != c[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            found = []
            for lo, hi in zip([0, *cut], [*cut, len(c)]):
                if len(np.unique(label[lo:hi])) > 1:
                    member = [np.frombuffer(s.as_py(), np.uint64) for s in t.column(5).slice(lo, hi - lo)]
                    found += cross_links(node[lo:hi], label[lo:hi], member, share)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    rows = dealt.select("c", "i", "j", "node", "label", "set").repartition("c", "i", "j").sortWithinPartitions("c", "i", "j")
    return rows.mapInArrow(task, "a long, b long")


def _whole_sets(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, n, set of the rows in ``wanted``, worked out anew from their texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            found = [shingler.shingles(t) for t in b.column(0).to_pylist()]
            cols = [pa.array([_node(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["node", "n", "set"])

    texts = source.join(wanted.select("row"), "row", "left_semi").select("text")
    return texts.mapInArrow(task, "node long, n long, set binary").dropDuplicates(["node"])


def near_dedup(docs: DataFrame, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept.  ``share``: least percentage of
    intersection to union; the tables are laid out for 80 and more."""
    rows = materialise(sketches(docs, id_col, text_col))
    # equal sets meet in each task before they are shuffled
    nodes = materialise(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("lefts").alias("lefts"), F.first("rights").alias("rights")
    ))
    pairs = materialise(candidates(nodes.where("lefts is not null")))
    of = lambda side: nodes.select(F.col("node").alias(side), F.concat("lefts", "rights").alias(f"keys_{side}"))
    beside = attach(pairs.where("sized").select("a", "b"), of("a"), ["a"], ["b"], 16).join(of("b"), "b")
    agree = F.size(F.filter(F.zip_with("keys_a", "keys_b", lambda x, y: x == y), lambda same: same))
    likely = materialise(beside.where(agree >= AGREE).select("a", "b"))
    crowded = pairs.where("crowded").select("a", "b")
    both = likely.unionByName(crowded)
    wanted = nodes.join(both.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    sets = materialise(_whole_sets(_source(docs, id_col, text_col), wanted))
    links = materialise(_verified(likely, sets, share))
    if crowded.limit(1).count():
        links = links.unionByName(materialise(_across(crowded, links, sets, share)))
    roots = components(links)
    named = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = attach(named.select("node", "root"), smallest, ["root"], ["node"], 16).select("node", "component_id")
    linked = attach(rows.where("node is not null").select("doc_id", "n", "node"), facts, ["node"], ["doc_id"]).select("doc_id", "n", "component_id")
    alone = rows.where("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
