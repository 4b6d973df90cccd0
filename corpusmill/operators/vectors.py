"""Exact and approximate cosine neighbours, hashed text vectors.

Neighbours are sought by crossed blocks: vectors are packed, one kept row a block, and a
cross join brings every block of vectors to every block of queries.  A task holds its
queries and the best of them so far, and the blocks of vectors pass; a pair of blocks writes
nothing, so disk grows with the vectors and not with their square."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import stable_hash
from corpusmill.operators.index import Index, idf_expr
from corpusmill.operators.topk import top_k_by_score
from corpusmill.session import bounded_broadcast

# Rows of a block of the comparison grid.
BLOCK, LEAST_BLOCK = 4096, 256


def _blocks(n: int, tasks: int) -> int:
    """Blocks to cut n rows into: at most BLOCK rows each, and enough to spread."""
    return max(1, -(-n // BLOCK), min(-(-n // LEAST_BLOCK), int(tasks**0.5)))


def _kth(sims: np.ndarray, k: int) -> np.ndarray:
    """At most the k-th greatest value of each row, and close to it: the k-th greatest of
    the maxima of some columns each, which is much less to look through."""
    groups = sims.shape[1] // 16
    if groups >= 4 * k:
        rest = sims[:, groups * 16 :]
        best = sims[:, : groups * 16].reshape(len(sims), 16, groups).max(axis=1)
        sims = np.concatenate([best, rest], axis=1)
    if sims.shape[1] <= k:
        return np.full(len(sims), -np.inf, sims.dtype)
    return np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]


def _query_blocks(n: int, tasks: int) -> int:
    """Blocks of queries: a task each, that meets all vectors."""
    return max(1, -(-n // BLOCK), min(tasks, -(-n // LEAST_BLOCK)))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column, a row each, in double precision."""
    vectors = column.combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if vectors.null_count or len(lengths) > 1:
        raise ValueError("vectors of one length, and none missing, are asked for")
    return x.reshape(len(vectors), -1)


def _packed(t: pa.Table) -> pa.Table:
    """The vectors of a block (a, b) in one row."""
    x = _matrix(t.column("v"))
    cell = lambda y: pa.array([np.ascontiguousarray(y).tobytes()], pa.binary())
    return pa.table({"a": t.column("a").slice(0, 1), "b": t.column("b").slice(0, 1), "ids": cell(t.column("id").to_numpy().astype(np.int64)), "v": cell(x), "dim": pa.array([x.shape[1]], pa.int64())})


def _kept_blocks(rows: DataFrame, n: int) -> DataFrame:
    """(a, b, ids, v, dim): one row for each block (a, b) of rows (a, b, id, v)."""
    blocks = rows.repartition(n, "a", "b").groupBy("a", "b").applyInArrow(_packed, "a long, b long, ids binary, v binary, dim long")
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _crossed(vectors: DataFrame, queries: DataFrame, state, found: str) -> DataFrame:
    """What ``state(ids, matrix)`` of each block of queries answers once it has met every block
    of vectors.  A task streams the vectors and holds its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, object] = {}
        for batch in batches:
            cell = lambda c, i, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: B023, E731 - used at once
            for i in range(batch.num_rows):
                blk, dim = batch.column("q_b")[i].as_py(), batch.column("dim")[i].as_py()
                if blk not in held:
                    held[blk] = state(cell("q_ids", i, np.int64).copy(), cell("q_v", i, np.float64).reshape(-1, batch.column("q_dim")[i].as_py()).copy())
                held[blk].met(batch.column("a")[i].as_py(), cell("ids", i, np.int64), cell("v", i, np.float64).reshape(-1, dim))
        for of in held.values():
            yield from of.answers()

    left = vectors.select("a", "ids", "v", "dim").coalesce(1)
    right = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("b", "ids", "v", "dim")])
    return left.crossJoin(right.hint("shuffle_replicate_nl")).mapInArrow(run, found)


def _same(ids: np.ndarray, vids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal ids on both sides."""
    by_id = np.argsort(vids, kind="stable")
    lo, hi = (np.searchsorted(vids, ids, side, sorter=by_id) for side in ("left", "right"))
    row = np.repeat(np.arange(len(ids)), hi - lo)
    return row, by_id[np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


class Nearest:
    """The k nearest vectors so far of a block's queries; ties by ascending id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, exclude_self: bool) -> None:
        self.ids, self.x, self.k, self.exclude_self = ids, _unit(x), k, exclude_self
        self.x4 = self.x.astype(np.float32)
        self.row, self.doc, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.least = np.full(len(ids), -np.inf)  # the k-th best, of the queries that have as many

    def met(self, _: int, vids: np.ndarray, v: np.ndarray) -> None:
        v = _unit(v)
        v4 = v.astype(np.float32)
        # single precision leaves most pairs out; what it may be wrong by, and rounding, is allowed for
        slack = np.float32(4 * (v.shape[1] + 4) * 2.0**-24 + 2e-6)
        whole = bool(np.isfinite(self.x4).all() and np.isfinite(v4).all())
        rows, docs, scores = [self.row], [self.doc], [self.score]
        for s in range(0, len(self.ids), LEAST_BLOCK):
            part = slice(s, s + LEAST_BLOCK)
            sims = self.x4[part] @ v4.T
            if not whole:
                sims[np.isnan(sims)] = -np.inf
            if self.exclude_self:
                sims[_same(self.ids[part], vids)] = -np.inf
            floor = self.least[part].copy()
            few = np.flatnonzero(floor == -np.inf)
            if len(few):
                floor[few] = _kth(sims[few], self.k)
            row, at = np.nonzero(sims >= (floor - slack)[:, None])
            there = sims[row, at] > -np.inf
            row, at = row[there], at[there]
            rows.append(s + row)
            docs.append(vids[at])
            scores.append(np.einsum("ij,ij->i", self.x[s + row], v[at]))
        row, doc, score = map(np.concatenate, (rows, docs, scores))
        order = np.lexsort((doc, -np.round(score, 6), row))
        rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        kept, last = order[rank < self.k], order[rank == self.k - 1]
        self.row, self.doc, self.score = row[kept], doc[kept], score[kept]
        self.least[row[last]] = score[last]

    def answers(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.doc), pa.array(self.score)], names=["query_id", "doc_id", "raw"])


def _id_and_vector(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    kind = df.schema[vec].dataType.simpleString()
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast(kind if kind == "array<float>" else "array<double>").alias("v"))


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """The rows (id, v) with their block (0, b) of n."""
    return df.withColumns({"a": F.lit(0).cast("long"), "b": F.pmod(F.xxhash64("id"), F.lit(n)).cast("long")})  # block choice only


def knn(queries: DataFrame, vectors: DataFrame, k: int, q_id: str = "vec_id", v_id: str = "vec_id", vec: str = "embedding",
        exclude_self: bool = True) -> DataFrame:
    """Exact cosine top-k for a table of query vectors of any size.

    Every block of queries meets every block of vectors, scored in numpy; a block of
    queries keeps its top k (never all pairs).  Only the two row counts reach the driver."""
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nq, nv = _query_blocks(queries.count(), tasks), _blocks(vectors.count(), tasks)
    qs, vs = _kept_blocks(_dealt(_id_and_vector(queries, q_id, vec), nq), nq), _kept_blocks(_dealt(_id_and_vector(vectors, v_id, vec), nv), nv)
    found = _crossed(vs, qs, lambda ids, x: Nearest(ids, x, k, exclude_self), "query_id long, doc_id long, raw double")
    scored = found.select("query_id", "doc_id", F.round("raw", 6).alias("score"))
    return top_k_by_score(scored, "query_id", "score", "doc_id", k).select("query_id", "doc_id", "rank", "score")


def embed_text(index: Index, dim: int = 64) -> DataFrame:
    """Signed hashed tf*idf per document, unit length, in sparse long form
    (doc_id, dim, value).  The sign is a second bit of the same stable hash."""
    h = stable_hash(F.col("term"))
    w = index.postings.join(index.term_stats, "term").select(
        "doc_id",
        F.pmod(h, F.lit(dim)).alias("dim"),
        (F.when(F.pmod(F.shiftright(h, 32), F.lit(2)) == 0, 1.0).otherwise(-1.0) * F.col("tf") * idf_expr(index.n_docs, F.col("df"))).alias("x"),
    )
    v = w.groupBy("doc_id", "dim").agg(F.sum("x").alias("x"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("doc_id")))  # at most ``dim`` rows per document
    return v.select("doc_id", "dim", F.round(F.col("x") / norm, 6).alias("value"))


def dense(sparse: DataFrame, dim: int, id_col: str = "doc_id") -> DataFrame:
    """Sparse long form to a fixed-width array<double> (at most ``dim`` entries per row)."""
    g = sparse.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("dim", "value"))).alias("_m"))
    return g.select(id_col, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0.0))).alias("vector"))


# ---- D15: approximate neighbours by sign codes ---------------------------------------------

# Signs a code holds; vectors a bucket is meant to hold; buckets a query looks into, chosen
# among those that differ in its NARROW least certain signs.
CODE_BITS, BUCKET, PROBES, NARROW = 256, 4096, 64, 12


def planes(spark, dim: int, n_bits: int = CODE_BITS, seed: int = 7) -> DataFrame:
    """(bit, signs): hyperplanes of random signs (Charikar 2002) from the stable hash of
    ``seed:bit:dimension``; a table that can be stored beside its codes."""
    sign = lambda d: F.when(F.pmod(stable_hash(F.concat(F.lit(f"{seed}:"), F.col("bit"), F.lit(f":{d}"))), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    return spark.range(n_bits).select(F.col("id").alias("bit"), F.array(*[sign(d) for d in range(dim)]).alias("signs"))


def probed(margin: np.ndarray, n_probes: int) -> np.ndarray:
    """Per row the buckets to look into, nearest first: the bucket of its signs, then
    those whose differing signs have the least sum of squared margins."""
    n, bits = margin.shape
    base = (margin >= 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(n, np.int64)
    narrow = min(bits, NARROW)
    weak = np.argsort(np.abs(margin), axis=1, kind="stable")[:, :narrow]
    flips = (np.arange(1 << narrow)[:, None] >> np.arange(narrow)) & 1
    cost = np.take_along_axis(margin, weak, 1) ** 2 @ flips.T
    pick = np.argsort(cost, axis=1, kind="stable")[:, : min(n_probes, 1 << narrow)]
    change = (1 << weak.astype(np.int64)) @ flips.T.astype(np.int64)
    return base[:, None] ^ np.take_along_axis(change, pick, 1)


def codes(df: DataFrame, id_col: str, vec: str, signs: np.ndarray, bucket_bits: int, n_probes: int, with_vectors: bool = False) -> DataFrame:
    """(id, code, bucket[, v]): one row per vector, or per vector and bucket to look into."""
    kind = df.schema[vec].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            margin = np.stack(pdf["v"].to_numpy()).astype(np.float64) @ signs.T
            packed = np.packbits(margin >= 0, axis=1, bitorder="little").view("<i8")
            buckets = probed(margin[:, :bucket_bits], n_probes)
            at = np.repeat(np.arange(len(pdf)), buckets.shape[1])
            out = {"id": pdf["id"].to_numpy()[at], "code": list(packed[at]), "bucket": buckets.ravel()}
            yield pd.DataFrame(out | ({"v": list(np.stack(pdf["v"].to_numpy())[at])} if with_vectors else {}))

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast(kind).alias("v")).where("v is not null")
    return src.mapInPandas(code, "id long, code array<long>, bucket long" + (f", v {kind}" if with_vectors else ""))


def _nearest(t: pa.Table, m: int, exclude_self: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every query of a group its place, the distances of the m nearest codes and more
    that are as far as the m-th, and their places."""
    is_query = t.column("is_query").to_numpy()
    ids = t.column("id").to_numpy()
    bits = t.column("code").combine_chunks().flatten().to_numpy().reshape(len(ids), -1).view(np.uint64)
    at_q, at_v = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    codes_v, ids_v = bits[at_v], ids[at_v]
    for i in at_q if len(at_v) else ():
        far = np.bitwise_count(codes_v ^ bits[i]).sum(axis=1, dtype=np.int64)
        there = ids_v != ids[i] if exclude_self else np.ones(len(far), bool)
        kept = far[there]
        if len(kept):
            least = np.partition(kept, m - 1)[m - 1] if len(kept) > m else kept.max()
            near = np.flatnonzero(there & (far <= least))
            yield i, far[near], at_v[near]


def _compared(m: int, exclude_self: bool):
    def compared(t: pa.Table) -> pa.Table:
        ids, limit = t.column("id").to_numpy(), t.column("limit").to_numpy()
        vectors = t.column("v").combine_chunks()
        x = vectors.flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
        norm = np.linalg.norm(x, axis=1)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for i, far, at in _nearest(t, m, exclude_self):
            near = far <= limit[i]
            far, at = far[near], at[near]
            out.append((np.full(len(at), ids[i]), ids[at], far, (x[at] * x[i]).sum(axis=1) / np.maximum(norm[at] * norm[i], 1e-300)))
        return pa.table(dict(zip(("query_id", "doc_id", "far", "raw"), map(np.concatenate, zip(*out)))))

    return compared


class ShortList:
    """The ``m`` vectors of nearest sign code so far of a block's queries, ties by ascending id, with
    their cosines.  Codes are compared as products of signs, which single precision adds exactly."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, signs: np.ndarray, bits: int, n_probes: int, m: int, k: int, exclude_self: bool) -> None:
        self.ids, self.x, self.m, self.k, self.exclude_self, self.signs = ids, x, m, k, exclude_self, signs
        margin = x @ signs.T
        self.code, self.buckets = self._code(margin), probed(margin[:, :bits], n_probes)
        self.count = np.zeros((len(ids), len(signs) + 1), np.int32)  # vectors met by distance
        self.limit = np.full(len(ids), len(signs), np.int64)
        self.norm = np.linalg.norm(x, axis=1)
        self.found: list[tuple] = []
        self.waiting = 0

    @staticmethod
    def _code(margin: np.ndarray) -> np.ndarray:
        return np.where(margin >= 0, np.float32(1), np.float32(-1))

    def met(self, bucket: int, vids: np.ndarray, v: np.ndarray) -> None:
        asked = np.flatnonzero((self.buckets == bucket).any(axis=1))
        if not len(asked):
            return
        n_bits, norm = len(self.signs), np.linalg.norm(v, axis=1)
        code = self._code(v @ self.signs.T).T
        for s in range(0, len(asked), LEAST_BLOCK):
            of = asked[s : s + LEAST_BLOCK]
            far = (np.float32(n_bits) - self.code[of] @ code) * np.float32(0.5)
            if self.exclude_self:
                far[_same(self.ids[of], vids)] = np.inf
            limit = self.limit[of].astype(np.float32)
            some = np.flatnonzero(self.count[of].sum(axis=1) < self.m)
            if len(some) and len(vids) > self.m:
                limit[some] = np.minimum(limit[some], np.partition(far[some], self.m - 1, axis=1)[:, self.m - 1])
            row, at = np.nonzero(far <= limit[:, None])
            distance, row = far[row, at].astype(np.int64), of[row]
            cosine = np.einsum("ij,ij->i", self.x[row], v[at]) / np.maximum(self.norm[row] * norm[at], 1e-300)
            self.found.append((row, vids[at], distance, cosine))
            self.waiting += len(row)
            place = np.searchsorted(of, row) * (n_bits + 1) + distance
            self.count[of] += np.bincount(place, minlength=len(of) * (n_bits + 1)).reshape(len(of), -1).astype(np.int32)
            upto = np.cumsum(self.count[of], axis=1)
            self.limit[of] = np.where(upto[:, -1] >= self.m, (upto >= self.m).argmax(axis=1), n_bits)
        if self.waiting > 4 * self.m * len(self.ids):
            self._leave()

    def _leave(self) -> None:
        """Gives up what is farther than the limit by now."""
        found = [np.concatenate(x) for x in zip(*self.found)]
        near = found[2] <= self.limit[found[0]]
        self.found, self.waiting = [tuple(x[near] for x in found)], int(near.sum())

    def answers(self) -> Iterator[pa.RecordBatch]:
        """Of each short list the k of greatest cosine, and more that rounding may bring among them."""
        if not self.found:
            return
        self._leave()
        row, doc, far, cosine = self.found[0]
        order = np.lexsort((doc, far, row))
        kept = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < self.m]
        kept = kept[np.lexsort((doc[kept], -cosine[kept], row[kept]))]
        row, doc, cosine = row[kept], doc[kept], cosine[kept]
        first = np.searchsorted(row, row)
        last = np.minimum(first + self.k, np.searchsorted(row, row, side="right")) - 1
        near = ~(cosine < cosine[last] - 2e-6)
        yield pa.RecordBatch.from_arrays([pa.array(self.ids[row[near]]), pa.array(doc[near]), pa.array(cosine[near])], names=["query_id", "doc_id", "raw"])


def knn_approx(queries: DataFrame, vectors: DataFrame, k: int, q_id: str = "vec_id", v_id: str = "vec_id", vec: str = "embedding",
               short_list: int = 20, n_bits: int = CODE_BITS, bucket: int = BUCKET, n_probes: int = PROBES, seed: int = 7, exclude_self: bool = True) -> DataFrame:
    """The ``short_list * k`` vectors of nearest sign code are compared exactly.

    Buckets are told apart by as many signs as leave about ``bucket`` vectors in each,
    and a query looks into its ``n_probes`` nearest ones; below two buckets' worth all codes
    are looked at.  Blocks of a bucket pass the blocks of queries, which compare what they
    look into by code and keep the short list.  Ties of codes and of scores go to the smaller id."""
    spark, n = vectors.sparkSession, vectors.count()
    first = vectors.select(vec).where(F.col(vec).isNotNull()).first()
    if first is None:
        return spark.createDataFrame([], "query_id long, doc_id long, rank long, score double")
    signs = np.array([r["signs"] for r in planes(spark, len(first[0]), n_bits, seed).orderBy("bit").collect()])  # n_bits rows
    bits = max(0, int(np.log2(max(n, 1) / bucket)))
    m, tasks = short_list * k, int(spark.conf.get("spark.sql.shuffle.partitions"))
    vs = codes(vectors, v_id, vec, signs, bits, 1, True).select(F.col("bucket").alias("a"), "id", "v").persist(StorageLevel.MEMORY_AND_DISK)
    sizes = vs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    blocks = vs.join(bounded_broadcast(sizes), "a").select("a", F.pmod(F.xxhash64("id"), F.col("parts")).cast("long").alias("b"), "id", "v")  # block choice only
    nq = _query_blocks(queries.count(), tasks)
    qs = _kept_blocks(_dealt(_id_and_vector(queries, q_id, vec).where("v is not null"), nq), nq)
    vs = _kept_blocks(blocks, max(1, -(-n // BLOCK), min(tasks, -(-n // LEAST_BLOCK))))
    found = _crossed(vs, qs, lambda ids, x: ShortList(ids, x, signs, bits, n_probes, m, k, exclude_self), "query_id long, doc_id long, raw double")
    scored = found.select("query_id", "doc_id", F.round("raw", 6).alias("score"))
    return top_k_by_score(scored, "query_id", "score", "doc_id", k).select("query_id", "doc_id", "rank", "score")
