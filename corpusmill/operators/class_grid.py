"""Count-model scoring for any number of classes.

Rows and classes are packed, one kept row a block: classes with their priors, norms and
term weights, rows with their terms.  A cross join brings every block of classes to every
block of rows; a task holds a block of rows, which the classes pass, and scores each row
against a block of classes at once in numpy.  It keeps the row's best k and its share of
the softmax, so a pair of blocks writes nothing: disk grows with the model and the rows,
not with their product.  No table of classes reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.bounded import _spans

# Term weights and classes, terms and rows of a block; blocks are cut no further than LEAST.
WEIGHTS, CLASSES, TERMS, LEAST = 2_000_000, 16_384, 1_000_000, 20_000
CLASS, WEIGHT, ROW, TERM = range(4)


def _bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(cell: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(cell.as_buffer()).read_all()


def _packed_classes(t: pa.Table) -> pa.Table:
    """One row of a block: its classes, its words with where their weights begin, the weights."""
    kind = t.column("kind")
    classes, weights = (t.filter(pc.equal(kind, x)) for x in (CLASS, WEIGHT))
    classes = classes.sort_by("label")  # ties go to the smaller label
    words = pc.unique(weights.column("term"))
    owner = pc.index_in(weights.column("label"), value_set=classes.column("label").combine_chunks()).to_numpy()
    code = pc.index_in(weights.column("term"), value_set=words).to_numpy()
    order = np.argsort(code, kind="stable")
    edge = np.searchsorted(code[order], np.arange(len(words) + 1))
    cells = (
        classes.select(["label", "a", "b"]), pa.table({"term": words, "start": edge[:-1], "end": edge[1:]}),
        pa.table({"owner": owner[order].astype(np.int32), "weight": weights.column("a").to_numpy()[order]}),
    )
    return pa.table({"classes": pa.array([_bytes(cells[0])], pa.binary()), "words": pa.array([_bytes(cells[1])], pa.binary()), "weights": pa.array([_bytes(cells[2])], pa.binary())})


def _packed_rows(t: pa.Table) -> pa.Table:
    """One row of a block: its rows with where their terms begin, the terms."""
    rows, terms = (t.filter(pc.equal(t.column("kind"), x)) for x in (ROW, TERM))
    row = pc.index_in(terms.column("id"), value_set=rows.column("id").combine_chunks())
    terms, row = terms.filter(pc.is_valid(row)), pc.drop_null(row).to_numpy()
    order = np.argsort(row, kind="stable")
    edge = np.searchsorted(row[order], np.arange(rows.num_rows + 1))
    rows = pa.table({"id": rows.column("id"), "L": rows.column("a"), "start": edge[:-1], "end": edge[1:]})
    return pa.table({"rblk": t.column("rblk").slice(0, 1), "rows": pa.array([_bytes(rows)], pa.binary()), "terms": pa.array([_bytes(terms.take(pa.array(order)).select(["term", "a"]))], pa.binary())})


class Scored:
    """A block of rows, the k best classes of each so far and its share of the softmax."""

    def __init__(self, rows: pa.Table, terms: pa.Table, k: int, places: int) -> None:
        self.ids, self.k, self.places = rows.column("id").combine_chunks(), k, places
        self.length, self.start, self.end = (rows.column(c).to_numpy() for c in ("L", "start", "end"))
        self.term, self.times = terms.column("term"), terms.column("a").to_numpy()
        self.row, self.score, self.label = np.empty(0, np.int64), np.empty(0), []
        self.top, self.mass = np.full(len(self.ids), -np.inf), np.zeros(len(self.ids))

    def met(self, classes: pa.Table, words: pa.Table, weights: pa.Table) -> None:
        labels, prior, norm = classes.column("label").to_pylist(), classes.column("a").to_numpy(), classes.column("b").to_numpy()
        if not labels:
            return
        lo, hi = words.column("start").to_numpy(), words.column("end").to_numpy()
        owner, weight = weights.column("owner").to_numpy(), weights.column("weight").to_numpy()
        term = pc.fill_null(pc.index_in(self.term, value_set=words.column("term").combine_chunks()), -1).to_numpy()
        rows, found, scores, few = [self.row], [], [self.score], min(self.k, len(labels))
        for i, length in enumerate(self.length):
            own = term[self.start[i] : self.end[i]]
            known = own >= 0
            place, many = _spans(lo[own[known]], hi[own[known]])
            times = self.times[self.start[i] : self.end[i]][known]
            s = prior - length * norm + np.bincount(owner[place], np.repeat(times, many) * weight[place], len(labels))
            s = np.round(s, self.places)
            near = np.flatnonzero(s >= np.partition(s, len(s) - few)[len(s) - few])
            near = near[np.argsort(-s[near], kind="stable")][:few]
            top = max(self.top[i], s[near[0]])
            self.mass[i] = self.mass[i] * np.exp(self.top[i] - top) + np.exp(s - top).sum()
            self.top[i] = top
            rows.append(np.full(few, i))
            scores.append(s[near])
            found += [labels[c] for c in near]
        label, row, score = self.label + found, np.concatenate(rows), np.concatenate(scores)
        name = {x: n for n, x in enumerate(sorted(set(label)))}
        order = np.lexsort(([name[x] for x in label], -score, row))
        order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < self.k]
        self.row, self.score, self.label = row[order], score[order], [label[i] for i in order]

    def answers(self) -> pa.RecordBatch:
        nth = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        cols = {"row_id": self.ids.take(pa.array(self.row)), "label": pa.array(self.label, pa.string()), "score": pa.array(self.score), "top": pa.array(self.top[self.row]), "mass": pa.array(self.mass[self.row]), "nth": pa.array(nth, pa.int64())}
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _crossed(k: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Scored] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda c: _table(batch.column(c)[i])  # noqa: B023, E731 - used at once
                blk = batch.column("rblk")[i].as_py()
                if blk not in held:
                    held[blk] = Scored(cell("rows"), cell("terms"), k, places)
                held[blk].met(cell("classes"), cell("words"), cell("weights"))
        for of in held.values():
            yield of.answers()

    return run


def rank_classes(classes: DataFrame, weights: DataFrame, rows: DataFrame, terms: DataFrame, sizes: dict[str, int], k: int, places: int = 4) -> DataFrame:
    """(row_id, label, score, prob, rank): the top k classes of every row.

    ``classes``: label, prior, norm; ``weights``: label, term, w; ``rows``: row_id, L (its
    known terms); ``terms``: row_id, term, cnt; ``sizes``: rows of these four tables."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nc = max(1, -(-sizes["weights"] // WEIGHTS), -(-sizes["classes"] // CLASSES))
    n = sizes["terms"] + sizes["rows"]
    nr = max(1, -(-n // TERMS), min(-(-n // LEAST), tasks))  # a task for each block of rows
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("long")  # noqa: E731 - block choice only
    id_type = rows.schema["row_id"].dataType
    no_text, zero, what = F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("b"), lambda x: F.lit(x).alias("kind")
    cblk, rblk = own("label", nc).alias("cblk"), own("row_id", nr).alias("rblk")
    of_classes = classes.select(cblk, what(CLASS), "label", no_text, F.col("prior").alias("a"), F.col("norm").alias("b")).unionByName(
        weights.select(cblk, what(WEIGHT), "label", "term", F.col("w").alias("a"), zero)
    )
    of_rows = rows.select(rblk, what(ROW), F.col("row_id").alias("id"), no_text, F.col("L").alias("a")).unionByName(
        terms.select(rblk, what(TERM), F.col("row_id").alias("id"), "term", F.col("cnt").alias("a"))
    )
    cb = of_classes.repartition(nc, "cblk").groupBy("cblk").applyInArrow(_packed_classes, "classes binary, words binary, weights binary").persist(StorageLevel.MEMORY_AND_DISK)
    rb = of_rows.repartition(nr, "rblk").groupBy("rblk").applyInArrow(_packed_rows, "rblk long, rows binary, terms binary").persist(StorageLevel.MEMORY_AND_DISK)
    # a task streams the classes and holds its rows
    pairs = cb.coalesce(1).crossJoin(rb.hint("shuffle_replicate_nl"))
    found = pairs.mapInArrow(_crossed(k, places), f"row_id {id_type.simpleString()}, label string, score double, top double, mass double, nth long")
    prob = F.round(F.exp(F.col("score") - F.col("top")) / F.col("mass"), 6).alias("prob")
    return found.select("row_id", "label", F.round("score", places).alias("score"), prob, (F.col("nth") + 1).alias("rank"))
