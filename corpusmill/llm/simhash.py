"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is cut into 32 segments of two bits; its embedding is the bit
count of each segment, 0 to 2.  The Manhattan distance of two embeddings never
exceeds the bit distance of the fingerprints, so it is a lower bound.  Counts are
kept as thermometer codes (0, 1, 2 as 00, 01, 11): then one step on the grid is one
bit and the Manhattan distance is the bit count of an XOR.

Range-join: the embedding is cut into a side of FIRST segments and a shorter one.
Fingerprints within four bits lie at most two grid steps apart on the first side or
at most one on the second (within five: two on either; within three: one).  Points
two steps apart share a grid point one step from both, and points one step apart
share one that is the home of either: each point visits the cells within one step,
and the points that meet in a cell are the candidates.

A cell's members are checked exactly: first the lower bound, then the bit distance.
A cell yields a spanning forest of its links, never all its pairs; a cell of many
members is cut into blocks, every pair of blocks being one group, so no group grows
with the cell.  Components come from alternating large-star and small-star rounds.

Null and empty texts have no words and fingerprint zero, which links like any
other; a null id is nobody's smallest id; repeated rows each come back; extra
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, materialise, run_of

# A cell is checked in blocks of about so many members; cells of up to SMALL members
# compare all pairs; a hot cell's members meet its size under so many salts.
BLOCK, SMALL, SALTS = 4096, 32, 16
# Edges that a task of a star round takes; tasks that even a small round may use.
TASK_EDGES, LEAST_TASKS = 50_000, 32
# Segments of the first side of the grid, of 32 in all.
FIRST = 17
LOW = 0x5555555555555555


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash: a bit is set if over half of the shingles set it."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return int(np.uint64(h(b" ".join(w), 42)).astype(np.int64))
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = (ends - np.fromiter(map(len, w), np.int64, len(w)) - 1)[: len(w) - words + 1].tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    step = 1 << 16  # a very long text is counted in parts
    for a in range(0, len(starts), step):
        hashes = np.fromiter((h(joined[i:j], 42) for i, j in zip(starts[a : a + step], stops[a : a + step])), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp: one row per document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, fp long")


def thermometer(fp: Column) -> Column:
    """The embedding: per segment the bit count 0, 1, 2 as 00, 01, 11."""
    high = F.shiftright(fp, 1).bitwiseAND(F.lit(LOW))
    low = fp.bitwiseAND(F.lit(LOW))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _cells(points: DataFrame) -> DataFrame:
    """(fp, side, cell, home): the grid points within one step of each embedding, on
    each side; ``home`` marks the point itself.  Setting or clearing one bit is a
    step if the code stays valid."""
    sides = points.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("code").bitwiseAND(F.lit((1 << 2 * FIRST) - 1).cast("long")).alias("half")),
        F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("code", 2 * FIRST).alias("half")),
    )).alias("x")).select("fp", "x.side", "x.half")
    moved = []
    for i in range(FIRST):
        low, high = F.lit(1 << 2 * i).cast("long"), F.lit(2 << 2 * i).cast("long")
        there = F.lit(True) if i < 32 - FIRST else F.col("side") == 0
        moved.append(F.when(there & (F.col("half").bitwiseAND(high) == 0), F.col("half").bitwiseXOR(low)))  # 0 <-> 1
        moved.append(F.when(there & (F.col("half").bitwiseAND(low) != 0), F.col("half").bitwiseXOR(high)))  # 1 <-> 2
    cells = sides.select("fp", "side", "half", F.explode(F.array(F.col("half"), *moved)).alias("cell")).where(F.col("cell").isNotNull())
    return cells.select("fp", "side", "cell", (F.col("cell") == F.col("half")).alias("home"))


def _codes(fps: np.ndarray) -> np.ndarray:
    low = np.uint64(LOW)
    a, b = fps & low, (fps >> np.uint64(1)) & low
    return a | b | ((a & b) << np.uint64(1))


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same members as all links within ``max_bits`` do.  Each
    member, once reached, is compared with those not reached yet: the lower bound
    first, then the bits."""
    codes, left, a, b = _codes(fps), np.arange(len(fps)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            close = np.bitwise_count(codes[left] ^ codes[at]) <= max_bits
            close[close] = np.bitwise_count(fps[left[close]] ^ fps[at]) <= max_bits
            near, left = left[close], left[~close]
            a.append(np.full(len(near), at))
            b.append(near)
            queue.extend(near.tolist())
    return (fps[np.concatenate(a)], fps[np.concatenate(b)]) if a else (fps[:0], fps[:0])


def cell_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of ``group`` (group numbers, ascending).  Groups of
    up to SMALL members compare all pairs, place k with place k + d for every d;
    larger ones build their forest."""
    sizes = np.bincount(group)[group]
    codes, a, b = _codes(fps), [], []
    small = np.flatnonzero(sizes <= SMALL)
    g, f, c = group[small], fps[small], codes[small]
    for d in range(1, SMALL):
        k = np.flatnonzero(g[d:] == g[:-d])
        if not len(k):
            break
        k = k[np.bitwise_count(c[k] ^ c[k + d]) <= max_bits]
        k = k[np.bitwise_count(f[k] ^ f[k + d]) <= max_bits]
        a.append(f[k])
        b.append(f[k + d])
    for x in np.unique(group[sizes > SMALL]):
        lo, hi = np.searchsorted(group, [x, x + 1])
        one, other = forest(fps[lo:hi], max_bits)
        a.append(one)
        b.append(other)
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links between distinct fingerprints that have the same components
    as all pairs within ``max_bits``.  ``prints`` has distinct fp."""
    if max_bits > 5:
        raise ValueError("the grid has cells for up to 5 differing bits")
    cells = _cells(prints.select("fp", thermometer(F.col("fp")).alias("code")))
    sizes = cells.groupBy("side", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("home"), F.min("fp").alias("a"), F.max("fp").alias("b"), F.bit_xor("fp").alias("x"))
    # on a side with a range of one step, one point of a pair is at home in the cell
    far = F.when(F.col("side") == 0, max_bits > 3).otherwise(max_bits > 4)
    sizes = materialise(sizes.where((F.col("n") > 1) & (far | F.col("home"))))
    # two or three members are known from the smallest, the largest and the XOR of all
    a, b, c = F.col("a"), F.col("b"), F.when(F.col("n") == 3, F.col("a").bitwiseXOR(F.col("b")).bitwiseXOR(F.col("x")))
    both_ways = F.array(*[F.struct(p.alias("a"), q.alias("b")) for p, q in ((a, b), (a, c), (b, c))])
    close = F.filter(both_ways, lambda p: (
        F.bit_count(thermometer(p["a"]).bitwiseXOR(thermometer(p["b"]))) <= max_bits) & (F.bit_count(p["a"].bitwiseXOR(p["b"])) <= max_bits))
    pairs = sizes.where("n <= 3").select(F.explode(close).alias("p")).select("p.a", "p.b")

    # a cell of up to BLOCK members is one group; a larger one meets its size under
    # SALTS keys and is checked block by block
    crowded = sizes.where("n > 3").select("side", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = cells.join(crowded.where("blocks = 1"), ["side", "cell"]).select("side", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    hot = crowded.where("blocks > 1")
    if hot.limit(1).count():
        salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = cells.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(salted, ["side", "cell", "salt"])
        dealt = dealt.withColumn("i", F.pmod(F.xxhash64("fp", "side"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        members = members.unionByName(dealt.select("side", "cell", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp"))
    key = ["side", "cell", "i", "j"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups lie together; the last one of a batch waits for the next batch."""

        def out(block: np.ndarray) -> pa.RecordBatch:
            new = np.any(block[1:, :4] != block[:-1, :4], axis=1)
            group = np.concatenate([[0], np.cumsum(new)])
            a, b = cell_links(group, np.ascontiguousarray(block[:, 4]).view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        rest = np.empty((0, 5), np.int64)
        for batch in batches:
            if batch.num_rows:
                block = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
                block = np.concatenate([rest, block])
                last = int(np.flatnonzero(np.any(block[:, :4] != block[-1, :4], axis=1))[-1]) + 1 if np.any(block[0, :4] != block[-1, :4]) else 0
                if last:
                    yield out(block[:last])
                rest = block[last:]
        if len(rest):
            yield out(rest)

    grouped = members.repartition(*key).sortWithinPartitions(*key).mapInArrow(task, "a long, b long")
    both = pairs.unionByName(grouped)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes that have
    an edge.  Alternates large-star and small-star until the edges are stars.

    A round has a dozen steps, each of which leaves files for every task: their tasks
    go by the number of edges, not by the session's shuffle partitions alone."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Links every node's neighbours (large: those above it, else those below
        and itself) to the smallest one."""
        if large:
            pairs = few(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = few(pairs.groupBy("u").agg(F.min("v").alias("m")))
        least = least.select("u", F.least("u", "m").alias("m"))
        with_least = attach(pairs, least, ["u"], ["v"], 16, tasks)
        if large:
            out = with_least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = with_least.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return few(few(out.where("u <> v")).distinct())

    def shape(pairs: DataFrame) -> tuple:
        return tuple(few(pairs).agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())

    pairs = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    tasks = max(LEAST_TASKS, -(-pairs.count() // TASK_EDGES))
    few = lambda df: df.coalesce(tasks)
    pairs = few(pairs)
    before = shape(pairs)
    while True:
        pairs = materialise(star(materialise(star(pairs, True)), False))
        after = shape(pairs)
        if after == before:
            roots = few(pairs.select("v").distinct()).select(F.col("v").alias("node"), F.col("v").alias("root"))
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = after


def near_dedup(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id of the component)."""
    rows = materialise(fingerprints(docs, words, id_col, text_col))
    # copies meet first per run, so a fingerprint of a third of all rows is no hot key
    prints = rows.groupBy("fp", run_of(["doc_id"]).alias("r")).agg(F.min("doc_id").alias("first")).groupBy("fp").agg(F.min("first").alias("first"))
    prints = materialise(prints)
    roots = components(links(prints, max_bits))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = attach(named.select("fp", "root"), smallest, ["root"], ["fp"], 16).select("fp", "component_id")
    return attach(rows, facts, ["fp"], ["doc_id"])


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
