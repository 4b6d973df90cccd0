"""Query reformulation: learned pairs first, then the nearest targets by spelling.

Candidates of a query are the targets that share a character 3-gram with it, A-Z taken
as a-z.  An edit spoils at most three of a query's grams, so a target within distance d
shares all but 3d of them, and one of any 3d + 1.  Where the two rarest grams of a query
bring few pairs, they give a first k-th best distance; with it, the 3d + 1 rarest grams and
the lengths find every candidate that can still be among the best k, and the frequent grams
stay out of the join.  No distance is ruled out beforehand.

Where the grams bring many pairs, as with a third-best target that has nothing to do with
the query, nearly every target is a candidate.  Such queries meet all targets in blocks, by
bit-parallel edit distance (Myers 1999, in words of 64 characters as by Hyyro 2003) of one
text and a block of texts at once.  Three things save comparisons and lose none:
  1. a query that lies near a target (its centre) is compared with those targets only that
     the triangle inequality leaves, by the distances of its centre: d(c, t) - d(q, c) is at
     most the query's k-th best distance so far.  A query without a centre is its own;
  2. centres are targets, so the distance of two targets serves the queries of both;
  3. only the k best of a block leave it.
The time stays a comparison of every two targets, which is a square by nature."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import char_grams
from corpusmill.operators.bounded import _spans
from corpusmill.operators.topk import top_k

GRAM = 3
PROBE = 2
# Pairs that the rarest grams of a query may bring; a query whose grams bring more than one of
# so many targets, and more than these, goes by blocks.
FEW, SHARE = 64, 32
# Texts of a block, and words that the letters of a block's texts may take at once.
BLOCK, WORDS = 8192, 4_000_000
# A query's centre lies within NEAR; it is sought among the targets that begin or end as the query
# does, where these are no more than FEW.
NEAR, ENDS = 4, (6, 12, 24)
# Targets that every query meets first, for its first k-th best distance.
SEEDS = 1024


def grams(text: str) -> Column:
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(char_grams(small, GRAM))


def _meeting(qg: DataFrame, tg: DataFrame) -> DataFrame:
    """(query, target, limit): distinct pairs that share one of the given grams and
    whose lengths differ by no more than the limit, if there is one."""
    close = F.col("limit").isNull() | (F.abs(F.length("query") - F.length("target")) <= F.col("limit"))
    return qg.join(tg, "g").where(close).select("query", "target", "limit").distinct()


def _held(targets: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(query, g, limit, pairs) of the queries' grams that can still tell a candidate, with
    the k-th best distance so far and the pairs that a query's grams bring; (target, g)."""
    tg = targets.select("target", F.explode(grams("target")).alias("g")).persist(StorageLevel.MEMORY_AND_DISK)
    df = tg.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    qg = queries.select("query", F.explode(grams("query")).alias("g"))
    rarest = Window.partitionBy("query").orderBy(F.coalesce("df", F.lit(0)), "g")  # as many rows as a query has grams
    qg = qg.join(df, "g", "left").where("df is not null").withColumn("nth", F.row_number().over(rarest))
    qg = qg.withColumn("so_far", F.sum("df").over(rarest)).drop("df").persist(StorageLevel.MEMORY_AND_DISK)
    probe = (F.col("nth") <= PROBE) & (F.col("so_far") <= FEW)
    near = _meeting(qg.where(probe).withColumn("limit", F.lit(None).cast("int")), tg)
    near = top_k(near.withColumn("d", F.levenshtein("query", "target")), "query", ["d", "target"], k)
    limit = near.where(F.col("rank") == k).select("query", F.col("d").alias("limit")).persist(StorageLevel.MEMORY_AND_DISK)
    held = qg.join(limit, "query", "left").where(F.col("limit").isNull() | (F.col("nth") <= 3 * F.col("limit") + 1))
    return held.withColumn("pairs", F.max("so_far").over(Window.partitionBy("query"))), tg


def candidates(targets: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, target, limit) of distinct ``query`` and ``target`` texts: all pairs that
    can be among the k nearest of a query, ties included, with the k-th best distance
    so far."""
    return _meeting(*_held(targets, queries, k))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, one after the other, and where each text begins and ends."""
    edge = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.int32), edge


def _letters(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct characters, and the number of each one among them."""
    there = np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
    there[codes] = True
    return np.flatnonzero(there), (np.cumsum(there, dtype=np.int64) - 1)[codes]


def _column(eq: list, pv: list, mv: list) -> None:
    """One more letter of the other texts: ``eq``, ``pv`` and ``mv`` are word by word, a place a pair."""
    one, p_in, m_in = np.uint64(1), None, None
    for w, (e, p, v) in enumerate(zip(eq, pv, mv)):
        xv = e | v
        if m_in is not None:
            e = e | m_in
        xh = (((e & p) + p) ^ p) | e
        ph, mh = v | ~(xh | p), p & xh
        if w + 1 < len(pv):
            p_out, m_out = ph >> np.uint64(63), mh >> np.uint64(63)
        ph, mh = (ph << one) | (one if p_in is None else p_in), (mh << one) if m_in is None else (mh << one) | m_in
        p[...], v[...] = mh | ~(xv | ph), ph & xv
        if w + 1 < len(pv):
            p_in, m_in = p_out, m_out


def _narrow(e, pv, mv, d, x, h) -> None:
    """``_column`` for texts of one word, in few steps and without new arrays."""
    np.bitwise_or(e, mv, x)
    np.bitwise_and(x, pv, d)
    np.add(d, pv, d)
    np.bitwise_xor(d, pv, d)
    np.bitwise_or(d, x, d)  # no step down the diagonal
    np.bitwise_or(pv, d, x)
    np.bitwise_xor(x, mv, x)
    np.add(x, x, x)  # not a step up along the text, one place on
    np.bitwise_and(pv, d, h)
    np.add(h, h, h)  # a step down, one place on
    np.bitwise_and(x, d, pv)
    np.bitwise_xor(d, pv, mv)
    np.bitwise_xor(x, pv, pv)
    np.bitwise_or(h, pv, pv)


def _bits(lengths: np.ndarray, width: int) -> np.ndarray:
    """Per word and text the bits of the text's letters."""
    left = np.clip(lengths - 64 * np.arange(width)[:, None], 0, 64).astype(np.uint64)
    some = np.minimum(left, np.uint64(63))
    return np.where(left == 64, ~np.uint64(0), (np.uint64(1) << some) - np.uint64(1))


def _differ(pv, mv, bits, n) -> np.ndarray:
    """Distances from the last column's steps and the lengths of the texts gone through."""
    up, down = (sum(np.bitwise_count(x & b).astype(np.int64) for x, b in zip(v, bits)) for v in (pv, mv))
    return n + up - down


class Lanes:
    """Texts that are compared with one other text at a time."""

    def __init__(self, texts: list[str]) -> None:
        self.n, self.parts = len(texts), []
        lengths = np.array([len(x) for x in texts], np.int64)
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            width = max(1, -(-int(lengths[order[start]]) // 64))
            end = int(np.searchsorted(lengths[order], 64 * width, side="right"))
            while True:  # fewer texts at once where their letters are many
                at = order[start:end]
                codes, edge = _codes([texts[i] for i in at])
                alphabet, code = _letters(codes)
                if (len(alphabet) + 1) * width * len(at) <= WORDS or len(at) == 1:
                    break
                end = start + max(1, len(at) // 2)
            lane = np.repeat(np.arange(len(at)), np.diff(edge))
            place = np.arange(len(code)) - edge[lane]
            eq = np.zeros((width, len(alphabet) + 1, len(at)), np.uint64)  # the last letter is in no text
            np.add.at(eq.reshape(-1), (place // 64 * eq.shape[1] + code) * len(at) + lane, np.uint64(1) << (place % 64).astype(np.uint64))
            number = {int(c): n for n, c in enumerate(alphabet)}
            self.parts.append((at, number, eq, _bits(lengths[at], width)))
            start = end

    def distances(self, text: str) -> np.ndarray:
        out = np.empty(self.n, np.int64)
        codes = [ord(c) for c in text]
        for at, number, eq, bits in self.parts:
            width, other, n = len(eq), len(number), len(at)
            pv, mv = np.full((width, n), ~np.uint64(0)), np.zeros((width, n), np.uint64)
            letters = [number.get(c, other) for c in codes]
            if width == 1:
                held = [np.empty(n, np.uint64) for _ in range(3)]
                for c in letters:
                    _narrow(eq[0, c], pv[0], mv[0], *held)
            else:
                for c in letters:
                    _column(list(eq[:, c]), list(pv), list(mv))
            out[at] = _differ(pv, mv, bits, len(codes))
        return out


class Coded:
    """Texts as numbers of the letters that all of them have."""

    def __init__(self, *lists: list[str]) -> None:
        codes, self.edge = _codes([x for texts in lists for x in texts])
        alphabet, self.code = _letters(codes)
        self.n_letters, self.length = len(alphabet), np.diff(self.edge)
        self.first = np.cumsum([0] + [len(x) for x in lists])  # where each list begins

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Edit distance of each text of ``a`` and its text of ``b``, given by their places."""
        out, words = np.empty(len(a), np.int64), np.maximum(1, -(-self.length[a] // 64))
        order = np.lexsort((self.length[b], words))
        start = 0
        while start < len(order):
            width = int(words[order[start]])
            most = min(BLOCK // 2, max(1, WORDS // (self.n_letters * width + 1)))
            at = order[start : min(start + most, int(np.searchsorted(words[order], width, side="right")))]
            n, lengths = len(at), self.length[b[at]]
            own, many = _spans(self.edge[a[at]], self.edge[a[at] + 1])
            lane = np.repeat(np.arange(n), many)
            place = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
            flat = np.zeros((width, self.n_letters * n), np.uint64)
            np.add.at(flat.reshape(-1), (place // 64 * self.n_letters + self.code[own]) * n + lane, np.uint64(1) << (place % 64).astype(np.uint64))
            other, many = _spans(self.edge[b[at]], self.edge[b[at] + 1])
            lane = np.repeat(np.arange(n), many)
            letters = np.zeros((int(lengths[-1]), n), np.int64)  # a row for each place in the texts of ``b``
            letters[np.arange(len(other)) - np.repeat(np.cumsum(many) - many, many), lane] = self.code[other] * n + lane
            pv, mv = np.full((width, n), ~np.uint64(0)), np.zeros((width, n), np.uint64)
            held, first = [np.empty(n, np.uint64) for _ in range(4)], np.searchsorted(lengths, np.arange(len(letters)), side="right").tolist()
            for j, letter in enumerate(letters):
                on = slice(first[j], n)  # texts longer than j
                if width == 1:
                    e = np.take(flat[0], letter[on], out=held[3][on], mode="clip")
                    _narrow(e, pv[0, on], mv[0, on], *[x[on] for x in held[:3]])
                else:
                    _column([e[letter[on]] for e in flat], [p[on] for p in pv], [m[on] for m in mv])
            out[at] = _differ(pv, mv, _bits(self.length[a[at]], width), lengths)
            start += n
        return out


_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class _Texts(dict):
    """The grams of texts, as ``grams`` has them, each worked out when first asked for."""

    def __missing__(self, text: str) -> frozenset:
        t = text.translate(_SMALL)
        self[text] = out = frozenset([t] if len(t) <= GRAM else [t[i : i + GRAM] for i in range(len(t) - GRAM + 1)])
        return out


class Members:
    """Queries, each with its centre's place and its distance from it, and the k nearest targets so
    far: places in the sorted texts of the other side."""

    def __init__(self, queries: list[str], centres: np.ndarray, far: np.ndarray, most: np.ndarray, k: int, number: np.ndarray | None = None) -> None:
        self.queries, self.centres, self.far, self.most, self.k = queries, centres, far, most, k
        self.number = np.arange(len(queries)) if number is None else number
        self.row, self.at, self.d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _found(self, row: np.ndarray, at: np.ndarray, between: np.ndarray, targets: list[str], grams: _Texts, coded: Coded, own: int, side: int):
        """Of pairs of members and targets those that can still count, with their distances.  The
        queries are list ``own`` of the coded texts, the targets list ``side``."""
        d = np.where(self.far[row] == 0, between, -1).astype(np.int64)
        off = np.flatnonzero(d < 0)
        d[off] = coded.distances(coded.first[own] + self.number[row[off]], coded.first[side] + at[off])
        on = np.flatnonzero(d <= self.most[row])
        on = on[np.array([not grams[self.queries[i]].isdisjoint(grams[targets[t]]) for i, t in zip(row[on], at[on])], bool)]
        return row[on], at[on], d[on]

    def _kept(self, row: np.ndarray, at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of each member's k nearest, and its limit after them."""
        order = np.lexsort((at, d, row))
        rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        most, last = self.most.copy(), order[rank == self.k - 1]
        most[row[last]] = np.minimum(most[row[last]], d[last])
        return order[rank < self.k], most

    def met(self, between: np.ndarray, first: int, targets: list[str], *texts) -> None:
        """``between``: distances, a column for each centre, a row for each of the ``targets`` from the ``first`` on."""
        if not len(self.queries) or not len(between):
            return
        k = min(len(between), self.k)
        near = np.partition(between, k - 1, axis=0)[k - 1][self.centres]
        self._merged(between, first, None, near, targets, *texts)  # the nearest to the centres tighten the limits
        self._merged(between, first, near, None, targets, *texts)

    def _merged(self, between: np.ndarray, first: int, above: np.ndarray | None, upto: np.ndarray | None, targets: list[str], *texts) -> None:
        """Takes the pairs within the limits whose centres' distances are above ``above``, up to ``upto``."""
        step = max(1, WORDS // len(self.queries)) if np.any(self.most >= _FAR) else len(between)
        for s in range(0, len(between), step):
            far = between[s : s + step, self.centres]
            there = far <= (self.most + self.far if upto is None else np.minimum(upto, self.most + self.far))
            at, row = np.nonzero(there if above is None else there & (far > above))
            row, at, d = self._found(row, first + s + at, far[at, row], targets, *texts)
            row, at, d = np.concatenate([self.row, row]), np.concatenate([self.at, at]), np.concatenate([self.d, d])
            kept, self.most = self._kept(row, at, d)
            self.row, self.at, self.d = row[kept], at[kept], d[kept]


_FAR = 1 << 40


def _side(t: pa.Table, k: int) -> tuple[list[str], Members]:
    """The distinct texts of one side of a group, and the queries whose centres they are."""
    text, query = t.column("text").to_pylist(), t.column("query").to_pylist()
    far, most = t.column("far").fill_null(0).to_numpy(), t.column("limit").fill_null(_FAR).to_numpy()
    texts = sorted(set(text))
    place = {x: i for i, x in enumerate(texts)}
    at = [i for i, x in enumerate(query) if x is not None]
    return texts, Members([query[i] for i in at], np.array([place[text[i]] for i in at], np.int64), far[at].astype(np.int64), most[at].astype(np.int64), k)


def _block_best(k: int):
    """The k nearest targets, by distance and target, of each query of a group among the
    group's targets that share a gram with it."""

    def best(t: pa.Table) -> pa.Table:
        lane = t.column("lane")
        lanes, own = _side(t.filter(lane), k)
        rows, other = _side(t.filter(pc.invert(lane)), k)
        both = t.column("a")[0].as_py() not in (-1, t.column("b")[0].as_py())
        sides, grams, coded = Lanes(lanes), _Texts(), Coded(lanes, rows, own.queries, other.queries)
        step = max(1, WORDS // max(1, len(lanes)))
        found: list[tuple[str, str, int]] = []
        for s in range(0, len(rows) if lanes else 0, step):
            between = np.stack([sides.distances(x) for x in rows[s : s + step]]).astype(np.int32)
            own.met(between, s, rows, grams, coded, 2, 1)
            if both:
                of = np.flatnonzero((other.centres >= s) & (other.centres < s + step))
                part = Members([other.queries[i] for i in of], other.centres[of] - s, other.far[of], other.most[of], k, of)
                part.met(between.T, 0, lanes, grams, coded, 3, 0)
                found += [(part.queries[i], lanes[t], d) for i, t, d in zip(part.row, part.at, part.d.tolist())]
        found += [(own.queries[i], rows[t], d) for i, t, d in zip(own.row, own.at, own.d.tolist())]
        q, x, d = zip(*found) if found else ((), (), ())
        return pa.table({"query": pa.array(q, pa.string()), "target": pa.array(x, pa.string()), "distance": pa.array(d, pa.int64())})

    return best


def _centred(targets: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, limit, centre, far): a target within NEAR of each query and its distance, where one
    is found; null where none is."""
    ends = lambda c: F.array_compact(F.array(*[F.when(F.length(c) >= n, F.concat(F.lit(f"{n}{side}"), part)) for n in ENDS for side, part in (("<", F.left(F.col(c), F.lit(n))), (">", F.right(F.col(c), F.lit(n))))]))
    t = targets.select("target", F.explode(ends("target")).alias("end"))
    t = t.join(t.groupBy("end").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= FEW).drop("n"), "end")
    pairs = queries.select("query", F.explode(ends("query")).alias("end")).join(t, "end").where(F.abs(F.length("query") - F.length("target")) <= NEAR)
    pairs = pairs.select("query", "target", F.levenshtein(F.col("query"), F.col("target"), NEAR).cast("bigint").alias("far")).where("far >= 0")
    near = pairs.groupBy("query").agg(F.min(F.struct("far", "target")).alias("c")).select("query", F.col("c.target").alias("centre"), F.col("c.far").alias("far"))
    return queries.join(near, "query", "left")


def _grid(n: int, tasks: int) -> tuple[int, int]:
    """Blocks to cut n texts into, and parts of a block that meets another."""
    blocks = max(1, -(-n // BLOCK))
    return blocks, max(1, -(-2 * tasks // (blocks * (blocks + 1) // 2)))


def _met(sides: list[DataFrame], n_groups: int, k: int) -> DataFrame:
    """(query, target, distance): the k nearest of each query in every group (a, b, r) of texts
    (text, query, far, limit), those that are compared at once (lane) and the others."""
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    # dealt by group already, so the grouping keeps this
    return rows.repartition(n_groups, "a", "b", "r").groupBy("a", "b", "r").applyInArrow(_block_best(k), "query string, target string, distance long")


def _by_block(targets: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, target, distance): the k nearest of each query in every group of targets.
    ``queries``: query, limit (null: none)."""
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not queries.limit(1).count():
        return queries.select("query", F.col("query").alias("target"), F.lit(0).cast("bigint").alias("distance"))
    cols = ("text", "query", "far", "limit")
    number = lambda c: c.cast("int")
    own = lambda n, seed=0: number(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(n)))  # noqa: E731 - block choice only
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = lambda df, lane, a, b, r: df.select(number(a).alias("a"), number(b).alias("b"), number(r).alias("r"), F.lit(lane).alias("lane"), *cols)
    bare = targets.select(F.col("target").alias("text"), F.lit(None).cast("string").alias("query"), F.lit(None).cast("bigint").alias("far"), F.lit(None).cast("bigint").alias("limit"))
    members = _centred(targets, queries).select(F.coalesce("centre", "query").alias("text"), "query", F.coalesce("far", F.lit(0)).cast("bigint").alias("far"), F.col("limit").cast("bigint").alias("limit"), F.col("centre").isNull().alias("alone"))
    members = members.persist(StorageLevel.MEMORY_AND_DISK)
    none, least = F.lit(-1), F.lit(0)

    # first a few targets alone: the k-th best distance among them spares most comparisons
    some = bare.orderBy(F.xxhash64("text"), "text").limit(SEEDS).persist(StorageLevel.MEMORY_AND_DISK)
    n = max(1, -(-members.select("text").distinct().count() // BLOCK), min(2 * tasks, -(-queries.count() // SEEDS)))
    seeded = _met([side(members, True, none, own(n), least), side(some.withColumn("_n", every(n)), False, none, F.col("_n"), least)], n, k)
    limit = seeded.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("seeded")).where(F.col("n") >= k).select("query", "seeded")
    members = members.join(limit, "query", "left").withColumn("limit", F.least("limit", "seeded")).drop("seeded").persist(StorageLevel.MEMORY_AND_DISK)

    # two blocks of targets meet once; queries without a centre meet the blocks of targets beside that
    blocks, parts = _grid(targets.count(), tasks)
    by_text = members.where(~F.col("alone")).drop("alone").unionByName(bare).withColumn("_b", own(blocks)).persist(StorageLevel.MEMORY_AND_DISK)
    b = F.col("_b")
    sides = [
        side(by_text.withColumn("_o", F.explode(F.sequence(b, F.lit(blocks - 1)))).withColumn("_r", every(parts)), True, b, F.col("_o"), F.col("_r")),
        side(by_text.withColumn("_o", F.explode(F.sequence(F.lit(0), b))), False, F.col("_o"), b, own(parts, 1)),
    ]
    n_groups = blocks * (blocks + 1) // 2 * parts
    alone = members.where("alone").drop("alone")
    n_alone = alone.count()
    if n_alone:
        more = max(1, -(-n_alone // BLOCK))
        parts = max(1, -(-2 * tasks // (more * blocks)))
        sides += [
            side(alone.withColumn("_o", every(blocks)).withColumn("_r", every(parts)), True, none, F.col("_o"), own(more) * parts + F.col("_r")),
            side(bare.withColumn("_b", own(blocks)).withColumn("_m", every(more)), False, none, b, F.col("_m") * parts + own(parts, 1)),
        ]
        n_groups += more * blocks * parts
    return _met(sides, n_groups, k)


def nearest(targets: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, target, distance): the candidates that keep their limit, of queries that go
    through blocks the k nearest of each group."""
    targets, queries = (df.persist(StorageLevel.MEMORY_AND_DISK) for df in (targets, queries))
    held, tg = _held(targets, queries, k)
    by_gram = F.col("pairs") <= max(FEW, targets.count() // SHARE)
    bound = F.coalesce("limit", F.greatest(F.length("query"), F.length("target")))
    found = _meeting(held.where(by_gram), tg).withColumn("distance", F.levenshtein("query", "target").cast("bigint"))
    found = found.where(F.col("distance") <= bound).drop("limit")
    rest = held.where(~by_gram).select("query", "limit").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    return found.unionByName(_by_block(targets, rest, k))


def reformulate(targets: DataFrame, queries: DataFrame, k: int, pairs: DataFrame | None = None, q_id: str = "query_id",
                q_text: str = "query", t_text: str = "target") -> DataFrame:
    """(query_id, target, rank, distance, learned).

    The k candidates of least Levenshtein distance, ties by target.  Targets learned
    for exactly this query text come first, with their own edit distance."""
    t = targets.select(F.col(t_text).alias("target")).where("target is not null").distinct()
    q = queries.select(F.col(q_id).alias("query_id"), F.col(q_text).alias("query")).where("query is not null")
    cand = nearest(t, q.select("query").distinct(), k).withColumn("learned", F.lit(0))
    if pairs is not None:
        learned = pairs.select(F.col("source").alias("query"), F.col("target")).join(q.select("query").distinct(), "query", "left_semi").distinct()
        learned = learned.select("query", "target", F.levenshtein("query", "target").cast("bigint").alias("distance"), F.lit(1).alias("learned"))
        cand = cand.unionByName(learned).groupBy("query", "target", "distance").agg(F.max("learned").alias("learned"))
    best = top_k(cand, "query", [F.col("learned").desc(), F.col("distance").asc(), F.col("target").asc()], k)
    return q.join(best, "query").select("query_id", "target", "rank", "distance", F.col("learned").cast("bigint").alias("learned"))
