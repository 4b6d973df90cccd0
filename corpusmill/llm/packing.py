"""Best-fit packing of token sequences: bounded-space, online.

A document's ids are cut from its end into pieces of ``limit`` tokens, the first one
shorter.  Tasks place pieces in arrival order (a hash of the document id): the open
bin with the least free space that still holds the piece takes it.  Open bins lie in
a bitset keyed by free space, so best fit is the lowest set bit from the piece's
length on.  At most ``open_bins`` are open; when one more is needed the fullest
closes.  Bins that a task leaves under ``settled`` full are opened again: their
pieces go to fewer tasks for a second round, bounded by the first round's open bins.

Null and empty texts are one end token; repeated rows are packed each by itself (the
place of equal rows among each other is of no matter); extra columns are ignored."""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialise
from corpusmill.llm.tokens import byte_symbols

ITEM = "piece int, start long, length long, ids_crc32 long"
# Fixed value: the byte-level split pattern of the vocabulary, without backtracking.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class Encoder:
    """Ids of whole texts as the tokenizers library gives them.  A byte-level vocabulary
    whose merges are numbered in order is read from the same file into tiktoken, which
    gives the same ids several times faster; other vocabularies, and texts that its
    splitter refuses, go to the tokenizers library itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.ranks = self._ranks(json.load(f))

    def _ranks(self, spec: dict):
        """The vocabulary for tiktoken, None where its rules are others."""
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        bytewise = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        added = spec["added_tokens"]
        if model["type"] != "BPE" or spec.get("normalizer") or not bytewise or any(odd) or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            return None
        vocab, special = model["vocab"], {t["content"]: t["id"] for t in added}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        byte = byte_symbols()
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [self._ids(t) for t in texts]

    def _ids(self, text: str) -> bytes:
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # a run too long for its splitter
                pass
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(ids: bytes, limit: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids): full pieces from the end, the first may be shorter."""
    n = len(ids) // 4
    first = n % limit or min(n, limit)
    at = 0
    for piece in range(-(-n // limit)):
        end = first if piece == 0 else at + limit
        yield piece, at, ids[4 * at : 4 * end]
        at = end


def pieces(docs: DataFrame, vocabulary: str, limit: int, end_id: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        e, end = encoder(vocabulary), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a in range(0, len(texts), 256):
                row, piece, start, length, crc, blob = [], [], [], [], [], []
                for i, ids in enumerate(e.encode(texts[a : a + 256])):
                    for p, s, part in cut(ids + end, limit):
                        row.append(a + i)
                        piece.append(p)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        blob.append(part)
                cols = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(blob, pa.binary())] if with_ids else []), names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, {ITEM}" + ", ids binary" * with_ids)


class BestFit:
    """A fixed number of open bins in a bitset keyed by free space."""

    def __init__(self, limit: int, open_bins: int):
        self.limit, self.open_bins = limit, open_bins
        self.by_free: dict[int, list[tuple[int, list]]] = defaultdict(list)
        self.mask = self.opened = self.count = 0

    def _take(self, free: int) -> tuple[int, list]:
        b = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        self.opened -= 1
        return b

    def add(self, n: int, row: tuple) -> list[tuple]:
        """Places a piece of n tokens; the rows of a bin that closes, each with
        its bin and offset."""
        closed: list[tuple] = []
        rest = self.mask >> n
        if rest:
            free = n + (rest & -rest).bit_length() - 1
            number, rows = self._take(free)
        else:
            if self.opened >= self.open_bins:
                closed = self._take((self.mask & -self.mask).bit_length() - 1)[1]
            number, rows, free = self.count, [], self.limit
            self.count += 1
        rows.append((*row, number, self.limit - free))
        if free == n:
            return closed + rows
        self.by_free[free - n].append((number, rows))
        self.mask |= 1 << (free - n)
        self.opened += 1
        return closed

    def left(self) -> Iterator[tuple[int, list[tuple]]]:
        """Free space and rows of the bins still open."""
        for free in sorted(self.by_free):
            for _, rows in self.by_free[free]:
                yield free, rows


def place(items: DataFrame, limit: int, open_bins: int, settled: float, tasks: int, level: int) -> DataFrame:
    """Adds sequence_id, offset and ``loose`` (the bin may be packed again)."""
    names = [*items.columns, "sequence_id", "offset", "loose"]
    schema = f"{items.schema.simpleString()[len('struct<') : -1]}, sequence_id long, offset long, loose boolean"
    at = items.columns.index("length")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds the rows of open bins only."""
        fit, first, kinds = BestFit(limit, open_bins), (level << 56) + (TaskContext.get().partitionId() << 32), None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            *cols, number, offset, loose = map(list, zip(*rows))
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            ids = pa.array([first + b for b in number], pa.int64())
            return pa.RecordBatch.from_arrays([*arrays, ids, pa.array(offset, pa.int64()), pa.array(loose, pa.bool_())], names)

        for batch in batches:
            kinds, done = batch.schema.types, []
            cols = [c.to_pylist() for c in batch.columns]
            for n, row in zip(cols[at], zip(*cols)):
                done.extend(fit.add(n, row))
            if done:
                yield out([(*r, False) for r in done])
        rest = [(*r, free > (1 - settled) * limit) for free, rows in fit.left() for r in rows]
        if rest:
            yield out(rest)

    order = F.xxhash64("doc_id", "piece")
    dealt = items.repartition(tasks, order).sortWithinPartitions(order, "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(task, schema)


def pack(
    docs: DataFrame, vocabulary: str, limit: int = 1024, end_id: int = 2, open_bins: int = 512, settled: float = 0.97,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = pieces(docs, vocabulary, limit, end_id, id_col, text_col, with_ids)
    placed = materialise(place(parts, limit, open_bins, settled, tasks, 0))
    done = placed.where(~F.col("loose"))
    again = placed.where("loose").drop("sequence_id", "offset", "loose")
    again = place(again, limit, open_bins, settled, max(1, tasks // 32), 1)
    return done.unionByName(again).drop("loose")
