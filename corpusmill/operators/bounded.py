"""Exact top-k scoring with upper bounds, for whole tables of queries.

Postings are cut into blocks of documents and query terms into blocks of queries;
every pair of blocks is one group, which returns its own top k per query, so no
(query, document) row is ever shuffled beside these.  A group keeps its documents'
postings; its queries pass by in parts.

Inside a group a term's largest contribution bounds what it can add.  The terms of
a query are taken by falling bound:
  1. the first ones, up to PROBE * k postings, are added up; the best CLOSER * k
     documents so far get their whole score, and the k-th best is the threshold;
  2. terms go on until the bounds of all that remain sum to less than the threshold:
     a document that has met no term by then cannot enter the top k;
  3. the remaining terms are looked up for the documents that can still reach the
     threshold, or read as they are where these documents are many.
The answers are those of scoring every pair.  Short queries leave most postings of
frequent terms out; whole documents as queries have too many terms for the bounds to
tell, and cost one pass over their terms' postings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Postings of a block of documents; blocks are cut no further than LEAST postings or query terms to
# spread work.  Rows of query terms that are scored at a time.
BLOCK, LEAST, QUERY_ROWS = 500_000, 50_000, 100_000
PROBE, CLOSER = 200, 4
# A looked-up posting costs about as much as so many read in a row.
LOOKUP = 4
# More than rounding to six places can move a score.
SLACK = 1e-5


@dataclass
class Work:
    """Postings of the queries' terms, and (query, document) contributions worked out."""

    postings: int = 0
    scored: int = 0


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the spans, one after the other, and their lengths."""
    length = end - start
    total = int(length.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(length) - length), length), length


class Block:
    """Postings of a block of documents, by term and by document."""

    def __init__(self, doc_id: np.ndarray, code: np.ndarray, sat: np.ndarray, n_terms: int) -> None:
        self.ids, doc = np.unique(doc_id, return_inverse=True)
        order = np.lexsort((doc, code))
        self.doc, self.sat = doc[order], sat[order]
        self.place = code[order].astype(np.int64) * len(self.ids) + self.doc  # ascending
        self.edge = np.searchsorted(code[order], np.arange(n_terms + 1))
        self.top = np.maximum.reduceat(self.sat, self.edge[:-1]) if len(sat) else np.zeros(n_terms)
        order = np.argsort(doc, kind="stable")
        self.term_of, self.sat_of = code[order], sat[order]
        self.doc_edge = np.searchsorted(doc[order], np.arange(len(self.ids) + 1))
        self.weight = np.zeros(n_terms)  # the weights of the query at hand

    def _sums(self, terms: np.ndarray, weights: np.ndarray, work: Work) -> np.ndarray:
        """What the terms add to each document."""
        at, length = _spans(self.edge[terms], self.edge[terms + 1])
        work.scored += len(at)
        return np.bincount(self.doc[at], np.repeat(weights, length) * self.sat[at], len(self.ids))

    def _whole(self, docs: np.ndarray, work: Work) -> np.ndarray:
        """The whole scores of ``docs``."""
        at, length = _spans(self.doc_edge[docs], self.doc_edge[docs + 1])
        part = self.weight[self.term_of[at]] * self.sat_of[at]
        work.scored += int(np.count_nonzero(part))
        return np.bincount(np.repeat(np.arange(len(docs)), length), part, len(docs))

    def _looked_up(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray, work: Work) -> np.ndarray:
        """What the terms add to ``docs``, by looking each pair up."""
        want = (terms[:, None].astype(np.int64) * len(self.ids) + docs).ravel()
        at = np.minimum(np.searchsorted(self.place, want), len(self.place) - 1)
        part = np.where(self.place[at] == want, self.sat[at], 0.0)
        work.scored += int(np.count_nonzero(part))
        return weights @ part.reshape(len(terms), len(docs))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, exclude: int | None = None, work: Work | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the top k documents; ties by ascending id."""
        work = work or Work()
        bound = weights * self.top[terms]
        order = np.argsort(-bound, kind="stable")
        terms, weights, bound = terms[order], weights[order], bound[order]
        upto = np.cumsum(self.edge[terms + 1] - self.edge[terms])
        work.postings += int(upto[-1]) if len(upto) else 0
        own = -1
        if exclude is not None and len(self.ids):
            at = int(np.searchsorted(self.ids, exclude))
            own = at if at < len(self.ids) and self.ids[at] == exclude else -1
        first = max(1, int(np.searchsorted(upto, PROBE * k, side="right")))
        acc = self._sums(terms[:first], weights[:first], work)
        if own >= 0:
            acc[own] = -np.inf
        docs = np.flatnonzero(acc > 0)
        if first < len(terms):
            self.weight[terms] = weights
            threshold, rest = -np.inf, np.concatenate([np.cumsum(bound[::-1])[::-1], [0.0]])
            if len(docs) >= k:
                if len(docs) > CLOSER * k:
                    docs = docs[np.argpartition(-acc[docs], CLOSER * k)[: CLOSER * k]]
                threshold = np.partition(self._whole(docs, work), -k)[-k] - SLACK
            end = min(len(terms), max(first, len(terms) + 1 - int(np.searchsorted(rest[::-1], threshold))))
            acc += self._sums(terms[first:end], weights[first:end], work)
            docs = np.flatnonzero((acc > 0) & (acc + rest[end] >= threshold))
            left = int(upto[-1] - upto[end - 1])
            if LOOKUP * len(docs) * (len(terms) - end) < left:
                score = acc[docs] + self._looked_up(docs, terms[end:], weights[end:], work)
            else:
                score = (acc + self._sums(terms[end:], weights[end:], work))[docs]
            self.weight[terms] = 0.0
        else:
            score = acc[docs]
        if len(docs) > 4 * k:
            near = score >= np.partition(score, -k)[-k] - SLACK
            docs, score = docs[near], score[near]
        top = np.lexsort((docs, -np.round(score, 6)))[:k]
        return self.ids[docs[top]], score[top]


def block_of(postings: pa.Table) -> tuple[Block, pa.Array]:
    """The block, and its terms in the order of their numbers."""
    term = postings.column("term").combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    return Block(postings.column("id").to_numpy(), term.indices.to_numpy(zero_copy_only=False), postings.column("v").to_numpy(), len(term.dictionary)), term.dictionary


class _Group:
    """One block of documents and the queries that meet it, a part of them at a time."""

    def __init__(self, k: int, exclude_self: bool) -> None:
        self.k, self.exclude_self = k, exclude_self
        self.postings: list[pa.Table] = []
        self.queries: list[pa.Table] = []
        self.waiting = 0
        self.block: Block | None = None
        self.terms: pa.Array | None = None

    def met(self, is_query: bool, rows: pa.Table):
        """Takes rows, postings before queries and these by id; the answers of queries that are whole."""
        if not is_query:
            if self.block is not None or self.queries:
                raise ValueError("a group's postings come before its queries")
            self.postings.append(rows)
        elif self.postings or self.block is not None:  # no posting: no answer
            self.queries.append(rows)
            self.waiting += rows.num_rows
            if self.waiting >= QUERY_ROWS:
                yield from self.answers(False)

    def answers(self, last: bool):
        if self.block is None and self.queries:
            self.block, self.terms = block_of(pa.concat_tables(self.postings))
            self.postings = []
        rows = pa.concat_tables(self.queries) if self.queries else None
        self.queries, self.waiting = [], 0
        if rows is None:
            return
        if not last:  # more of the last query may come
            whole = int(np.searchsorted(rows.column("id").to_numpy(), rows.column("id")[-1].as_py()))
            tail = rows.slice(whole)
            self.queries, rows = [tail], rows.slice(0, whole)
        if np.any(np.diff(rows.column("id").to_numpy()) < 0):
            raise ValueError("a group's queries come by id")
        code = pc.index_in(rows.column("term"), value_set=self.terms)
        known = pc.is_valid(code)
        code = pc.filter(code, known).to_numpy()
        qid, weight = (rows.column(c).filter(known).to_numpy() for c in ("id", "v"))
        cut = np.flatnonzero(np.diff(qid)) + 1
        out_q, out_d, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(qid)]):
            if hi > lo:
                docs, score = self.block.best(code[lo:hi], weight[lo:hi], self.k, int(qid[lo]) if self.exclude_self else None)
                out_q.append(np.full(len(docs), qid[lo]))
                out_d.append(docs)
                out_s.append(score)
        yield np.concatenate(out_q), np.concatenate(out_d), np.concatenate(out_s)


def _scored(k: int, exclude_self: bool, nq: int):
    """Works through rows that come by group, a group's postings first, its queries by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = None, None
        as_rows = lambda x, g: pa.RecordBatch.from_arrays([*map(pa.array, x), pa.array(np.full(len(x[0]), g // nq, np.int64))], names=["query_id", "doc_id", "raw", "dblk"])
        for batch in batches:
            t = pa.Table.from_batches([batch])
            g, is_query = t.column("grp").to_numpy(), t.column("is_query").to_numpy()
            t = t.select(["id", "term", "v"])
            cut = np.flatnonzero((np.diff(g) != 0) | (np.diff(is_query.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(g)]):
                if hi == lo:
                    continue
                if at != g[lo]:
                    if group is not None:
                        yield from (as_rows(x, at) for x in group.answers(True))
                    group, at = _Group(k, exclude_self), int(g[lo])
                yield from (as_rows(x, at) for x in group.met(bool(is_query[lo]), t.slice(lo, hi - lo)))
        if group is not None:
            yield from (as_rows(x, at) for x in group.answers(True))

    return run


def _grid(n_postings: int, n_terms: int, tasks: int) -> tuple[int, int]:
    """Blocks of documents and of queries: of a block of documents at most BLOCK postings, and
    enough groups to spread, so cut that few rows are sent to more than one.  A group's queries
    pass by, so their number costs no memory and they are cut only to spread."""
    least = max(1, -(-n_postings // BLOCK))
    nq = max(1, min(-(-n_terms // LEAST), int((tasks * n_terms / max(1, n_postings)) ** 0.5), -(-tasks // least)))
    return max(least, min(-(-n_postings // LEAST), tasks // nq)), nq


def grid_best(postings: DataFrame, weighted: DataFrame, k: int, n_postings: int, n_terms: int, exclude_self: bool = False, shard=None, n_shards: int = 1) -> tuple[DataFrame, int]:
    """(query_id, doc_id, raw, dblk): the top k of every query in each block of
    documents, and the number of blocks a shard has.  ``postings``: doc_id, term, sat;
    ``weighted``: query_id, term, w; ``shard``: the shard of a doc_id."""
    tasks = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nd, nq = _grid(n_postings, n_terms, tasks)
    nd = -(-nd // n_shards)
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("long")  # noqa: E731 - block choice only
    dblk = (own("doc_id", nd) if shard is None else shard * F.lit(nd) + own("doc_id", nd)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    p = postings.select(every(nq).alias("qblk"), dblk.alias("dblk"), F.lit(False).alias("is_query"), F.col("doc_id").alias("id"), "term", F.col("sat").alias("v"))
    q = weighted.select(own("query_id", nq).alias("qblk"), every(nd * n_shards).alias("dblk"), F.lit(True).alias("is_query"), F.col("query_id").alias("id"), "term", F.col("w").alias("v"))
    rows = p.unionByName(q).select((F.col("dblk") * nq + F.col("qblk")).alias("grp"), "is_query", "id", "term", "v")
    # dealt and sorted by group already, so the grouping keeps this order; ``met`` refuses another
    by_group = rows.repartition(nd * n_shards * nq, "grp").sortWithinPartitions("grp", "is_query", F.when(F.col("is_query"), F.col("id")))
    return by_group.groupBy("grp").applyInArrow(_scored(k, exclude_self, nq), "query_id long, doc_id long, raw double, dblk long"), nd
