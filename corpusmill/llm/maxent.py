"""Language-model scores from a hashed maximum-entropy model.

The probability of a word after its history is that of its class, times that of its
part of the class, times that of the word within the part.  The first two are
log-linear (maximum-entropy) softmaxes over hashed features of the history: the
previous word, the previous two words, and the one before the previous with the
previous skipped; for the part each feature is crossed with the class.  Within a
part, the word has its add-one relative frequency, the maximum-entropy answer for
features of the word alone.  Classes come from a hash of a word's last bytes, parts
from one of its first, so unseen words have both; each part holds one unseen
word; the end of a text is a class without parts.  All probabilities after a history
sum to one.

The number of weight rows (buckets) grows with the training tokens, one for every
``SHARE`` of them, up to ``max_buckets``, which bounds the broadcast of the weights
(16 floats a row); beyond that, rare features share rows.

Training: in each round every task makes gradient updates on its share of the texts,
in batches, and the tasks' weights are averaged by bucket, weighted by how often
each task met the bucket; they travel as 16-bit floats.  Rounds take disjoint shares, so each text is used once.

Word counts are exact, those of words over ``LONGEST`` bytes by their SHA-256.  The
most frequent words (a bounded number, of bounded length) go to the tasks by
broadcast; all others join their counts by word, where no word is frequent.

Null and empty texts are the end alone; rows that repeat id and text come back as
often as they occur; a null id counts as empty text for the hold-out; extra columns
are ignored."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialise

WIDTH, SUFFIX, PREFIX = 16, 3, 4  # classes, parts of a class
MIN_BITS, MAX_BUCKETS, SHARE = 14, 1 << 18, 16
ONES = np.ones(WIDTH, np.float32)  # a product with it sums short rows faster
FREQUENT, LONGEST = 300_000, 64
BATCH, RATE = 8192, 0.3
INDEX = 600_000
BLOCK = 1024  # buckets whose weights travel together
SKIP = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def key_of(word: bytes) -> str:
    """The word itself; of a long one its SHA-256 after a tab, which no word holds."""
    return word.decode() if len(word) <= LONGEST else "\t" + hashlib.sha256(word).hexdigest()


def bits_for(tokens: int, max_buckets: int = MAX_BUCKETS) -> int:
    """Bits of a bucket's number for so many training tokens."""
    most = max(max_buckets.bit_length() - 1, 1)
    return min(max((max(tokens, 1) // SHARE).bit_length(), MIN_BITS), most)


LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
CRC = np.arange(256, dtype=np.uint32)  # CRC-32 of a byte, by its polynomial
for _ in range(8):
    CRC = (CRC >> np.uint32(1)) ^ np.where(CRC & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
STEP = 0x01000193  # odd, so that it has an inverse among 32-bit numbers
BACK = pow(STEP, -1, 1 << 32)


KEPT: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of usual lengths are kept."""
    out = KEPT.get(base)
    if out is None or len(out) < n:
        out = np.full(max(n, INDEX), base, np.uint32)
        out[:1] = 1
        out = np.cumprod(out, dtype=np.uint32)
        if len(out) == INDEX:
            KEPT[base] = out
    return out[:n]


def crc_of(data: np.ndarray, at: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
    """CRC-32 of the first ``length`` bytes, ``most`` at most, from each place."""
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for k in range(most):
        byte = data.take(at + k, mode="clip")
        crc = np.where(length > k, CRC[(crc ^ byte) & np.uint32(255)] ^ (crc >> np.uint32(8)), crc)
    return ~crc


def hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word of the texts that lie in ``data`` between the offsets: its text,
    hash and part.  The hash is a polynomial of its lower-cased bytes, from running
    sums over all bytes."""
    blank, inner = BLANK[data], offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.append(True, blank[:-1])[: len(data)], np.append(blank[1:], True)[: len(data)]
    before[inner], after[inner - 1] = True, True
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    low = LOWER[data]
    sums = np.zeros(len(data) + 1, np.uint32)
    np.cumsum((low + np.uint32(1)) * powers(STEP, len(data)), dtype=np.uint32, out=sums[1:])
    h = (sums[end] - sums[start]) * powers(BACK, len(data)).take(start)
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    size = end - start
    tail = np.minimum(size, SUFFIX)
    leaf = (crc_of(low, end - tail, tail, SUFFIX) % np.uint32(WIDTH - 1) + np.uint32(1)) * np.uint32(WIDTH)
    leaf += (crc_of(low, start, size, PREFIX) >> np.uint32(8)) % np.uint32(WIDTH)
    return np.searchsorted(offsets[1:], start, side="right"), h, leaf.astype(np.uint8)


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and parts of all texts' tokens, each text preceded by two marks and
    ended by its end, and the places of the tokens among the marks."""
    texts = texts.cast(pa.string())
    _, ends, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    text, h, leaf = hashed(raw, offsets.astype(np.int64) - int(offsets[0]))
    at = np.arange(len(h)) + 3 * text + 2
    stop = np.cumsum(np.bincount(text, minlength=n)) + 3 * np.arange(n) + 2
    hashes, leaves, token = np.ones(len(h) + 3 * n, np.uint32), np.zeros(len(h) + 3 * n, np.uint8), np.zeros(len(h) + 3 * n, bool)
    hashes[at], hashes[stop], leaves[at] = h, 0, leaf
    token[at], token[stop] = True, True
    return hashes, leaves, np.flatnonzero(token)


class Index(dict):
    """Word (bytes) to number, with known count by number, and after ``fill`` hash and
    part.  Number 0 is the end of a text, 1 stands before its start."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__()
        self.known, self.words = known, [b"", b" "]
        self.hash, self.leaf, self.count = np.array([0, 1], np.uint32), np.zeros(2, np.uint8), np.full(1 << 16, -1, np.int64)

    def __missing__(self, w: bytes) -> int:
        i = len(self.words)
        if i == len(self.count):
            self.count = np.resize(self.count, 2 * i)
        self.words.append(w)
        self.count[i] = self.known.get(w if len(w) <= LONGEST else key_of(w).encode(), -1)
        self[w] = i
        return i

    def fill(self) -> None:
        new = self.words[len(self.hash) :]
        if new:
            data = np.frombuffer(b" ".join(new), np.uint8)
            _, h, leaf = hashed(data, np.array([0, len(data)]))
            self.hash, self.leaf = np.append(self.hash, h), np.append(self.leaf, leaf)


def numbers(texts: list[str | None], index: Index) -> tuple[np.ndarray, np.ndarray]:
    """All texts' word numbers, each text preceded by two marks and ended by 0; and
    the places where the texts end."""
    out: list[int] = []
    ends = []
    for t in texts:
        out += (1, 1)
        out += map(index.__getitem__, (t or "").encode().lower().split())
        out.append(0)
        ends.append(len(out) - 1)
    index.fill()
    return np.asarray(out, np.int64), np.asarray(ends, np.int64)


def features(h: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The hashes of the three features of the tokens at ``places``."""
    one, two = h[places - 1], h[places - 2]
    return np.stack([one * np.uint32(SKIP[0]), (one * np.uint32(SKIP[1])) ^ (two * np.uint32(SKIP[2])), (two + np.uint32(7)) * np.uint32(SKIP[1])])


def decisions(f: np.ndarray, leaf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The softmax decisions of a batch, all tokens' classes and then the parts of
    those that are no end: buckets by feature, number of the bias, the outcome, and
    the token's place in the batch."""
    c = leaf // WIDTH
    word = np.flatnonzero(c)
    crossed = (f[:, word] ^ (f[:, word] >> np.uint32(15))) * np.uint32(SKIP[2]) + c[word].astype(np.uint32) * np.uint32(SKIP[0])
    m = np.concatenate([f, crossed], axis=1)
    m ^= m >> np.uint32(15)
    m *= np.uint32(0x2C1B3C6D)
    m ^= m >> np.uint32(12)
    m *= np.uint32(0x297A2D39)
    m >>= np.uint32(32 - bits)
    bias = np.concatenate([np.zeros(len(c), np.intp), c[word].astype(np.intp)])
    return m, bias, np.concatenate([c, leaf[word] % WIDTH]).astype(np.intp), np.concatenate([np.arange(len(c)), word])


def outcome_scores(w: np.ndarray, m: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(z) and z of every decision and outcome, z being the score less the row's
    largest.  The last WIDTH rows of ``w`` are the biases."""
    z = w.take(m[0], axis=0)
    z += w.take(m[1], axis=0)
    z += w.take(m[2], axis=0)
    z += w[-WIDTH:].take(bias, axis=0)
    top = z
    while top.shape[1] > 1:  # halves: far faster than a maximum over short rows
        half = top.shape[1] // 2
        top = np.maximum(top[:, :half], top[:, half:])
    z -= top
    return np.exp(z), z


def leaf_log_probability(w: np.ndarray, f: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token's class and part."""
    m, bias, y, token = decisions(f, leaf, (len(w) - WIDTH).bit_length() - 1)
    e, z = outcome_scores(w, m, bias)
    return np.bincount(token, z[np.arange(len(y)), y] - np.log(e @ ONES), len(leaf))


def update(w: np.ndarray, seen: np.ndarray, energy: np.ndarray, f: np.ndarray, leaf: np.ndarray) -> None:
    """One gradient step on a batch, with a rate per bucket that falls with the
    gradients it has had."""
    m, bias, y, _ = decisions(f, leaf, (len(w) - WIDTH).bit_length() - 1)
    g, _ = outcome_scores(w, m, bias)
    g /= (g @ ONES)[:, None]
    g[np.arange(len(y)), y] -= 1
    # bucket and place in one number: sorting it sorts places by bucket
    key = np.sort(((m.astype(np.int64) << 32) | np.arange(len(y))).reshape(-1))
    ranked = key >> 32
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    rows, times = ranked[starts], np.diff(np.append(starts, len(key)))
    each = g.take(key & 0xFFFFFFFF, axis=0)
    step = each.take(starts, axis=0)
    several = np.flatnonzero(times > 1)  # most buckets occur once in a batch
    if len(several):
        more = np.repeat(times > 1, times)
        at = np.cumsum(times[several])
        step[several] = np.add.reduceat(each[more], at - times[several], axis=0)
    energy[rows] += np.einsum("ij,ij->i", step, step) / WIDTH
    step *= (RATE / np.sqrt(energy[rows]))[:, None].astype(np.float32)
    w[rows] = w.take(rows, axis=0) - step
    seen[rows] += times
    met = np.zeros((len(y), WIDTH), np.float32)
    met[np.arange(len(y)), bias] = 1
    step, times = met.T @ g, met.sum(axis=0).astype(np.int64)
    energy[-WIDTH:] += np.square(step).mean(axis=1)
    w[-WIDTH:] -= step * (RATE / np.sqrt(energy[-WIDTH:]))[:, None]
    seen[-WIDTH:] += times


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, leaf, n) over all texts, added up within tasks first: the word's key, its
    part and how often it occurs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            data = np.frombuffer(b" ".join(seen), np.uint8)
            _, _, leaf = hashed(data, np.array([0, len(data)]))
            words = pa.array([key_of(w) for w in seen], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(leaf, pa.int32()), pa.array(seen.values(), pa.int64())], ["word", "leaf", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update((t or "").encode().lower().split())
                if len(seen) > INDEX:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return rows.select("text").mapInArrow(task, "word string, leaf int, n long").groupBy("word", "leaf").agg(F.sum("n").alias("n"))


def mean_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means by bucket of the tasks' weights, added up as they come in: memory for
    the buckets alone, whatever the number of tasks."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for block, bucket, n, w in zip(*(c.to_pylist() for c in b.columns)):
            if block not in sums:
                sums[block] = np.zeros(BLOCK), np.zeros((BLOCK, WIDTH))
            at, times = np.frombuffer(bucket, np.uint16), np.frombuffer(n, np.uint32).astype(float)
            sums[block][0][at] += times
            sums[block][1][at] += times[:, None] * np.frombuffer(w, np.float16).reshape(-1, WIDTH)
    for block, (n, w) in sums.items():
        met = np.flatnonzero(n)
        flat = pa.array((w[met] / n[met][:, None]).astype(np.float32).reshape(-1))
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(met) + 1) * WIDTH, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([pa.array(met + block * BLOCK, pa.int32()), vectors], ["bucket", "w"])


def train(rows: DataFrame, rounds: int, bits: int) -> np.ndarray:
    """The weights: one row of WIDTH floats per bucket, then the biases of the class
    (0) and of each class's parts."""
    w = np.zeros(((1 << bits) + WIDTH, WIDTH), np.float32)
    for r in range(rounds):
        start = rows.sparkSession.sparkContext.broadcast(w)

        def task(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own = start.value.copy()
            seen, energy = np.zeros(len(own), np.int64), np.ones(len(own), np.float32)
            for b in batches:
                texts = b.column(0)
                for a in range(0, len(texts), 64):
                    hashes, leaves, places = sequences(texts.slice(a, 64))
                    f, leaf = features(hashes, places), leaves[places]
                    for k in range(0, len(leaf), BATCH):
                        update(own, seen, energy, f[:, k : k + BATCH], leaf[k : k + BATCH])
            met = np.flatnonzero(seen)
            if len(met):
                cuts = np.flatnonzero(np.diff(met // BLOCK, prepend=-1))
                found = [(m, seen[m].astype(np.uint32), own[m].astype(np.float16)) for m in np.split(met, cuts[1:])]
                cols = [
                    pa.array(met[cuts] // BLOCK, pa.int32()), pa.array([(m % BLOCK).astype(np.uint16).tobytes() for m, _, _ in found], pa.binary()),
                    pa.array([n.tobytes() for _, n, _ in found], pa.binary()), pa.array([v.tobytes() for _, _, v in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["block", "bucket", "n", "w"])

        share = rows.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r).select("text")
        parts = share.mapInArrow(task, "block int, bucket binary, n binary, w binary")
        got = parts.repartition("block").mapInArrow(mean_weights, "bucket int, w array<float>").toArrow()  # a row a bucket
        if got.num_rows:
            w[got.column("bucket").to_numpy()] = got.column("w").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH)
        start.unpersist()
    return w


def score_texts(
    docs: DataFrame, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text", hold_out: tuple[int, int] = (7, 2), max_buckets: int = MAX_BUCKETS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    training = rows.where(~held_out(F.col("doc_id"), *hold_out))
    counts = materialise(word_counts(training))
    texts = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = words + texts, distinct + (texts > 0)
    by_leaf = counts.groupBy(F.col("leaf").alias("c")).agg(F.sum(F.col("n") + 1).alias("n")).collect()  # WIDTH * WIDTH at most
    mass = np.ones(WIDTH * WIDTH)
    mass[0] = texts + 1
    for r in by_leaf:
        mass[r["c"]] += r["n"]
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    known = spark.sparkContext.broadcast({w.encode(): n for w, n in zip(top.column("word").to_pylist(), top.column("n").to_pylist())})
    model = spark.sparkContext.broadcast((train(training, rounds, bits_for(total, max_buckets)), np.log10(mass)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, log_mass = model.value
        index = Index(known.value)
        for b in batches:
            for a in range(0, b.num_rows, 64):
                part = b.column(1).slice(a, 64).to_pylist()
                ids, ends = numbers(part, index)
                places = np.flatnonzero(ids != 1)
                f, leaf = features(index.hash[ids], places), index.leaf[ids[places]]
                by_leaf = np.empty(len(leaf))
                for k in range(0, len(leaf), BATCH):
                    by_leaf[k : k + BATCH] = leaf_log_probability(w, f[:, k : k + BATCH], leaf[k : k + BATCH])
                by_leaf = by_leaf / np.log(10) - log_mass[leaf]
                found = index.count[ids[places]]
                owner = np.searchsorted(ends, places)
                size = len(part)
                tokens = np.bincount(owner, minlength=size)
                logs = np.bincount(owner, np.where(found >= 0, np.log10(np.maximum(found, 0) + 1.0), 0.0), size)
                seen = np.bincount(owner, found >= 0, size).astype(np.int64)
                cls = np.bincount(owner, by_leaf, size)
                rare = np.flatnonzero((found < 0) & (ids[places] > 1))
                pair, times = np.unique(owner[rare] * len(index.words) + ids[places][rare], return_counts=True)
                rare_owner, rare_word = pair // len(index.words), pair % len(index.words)
                digest = np.asarray([xxhash.xxh64_intdigest(t) for t in part], np.uint64).view(np.int64)
                doc = b.column(0).slice(a, 64)
                at = pa.array(np.concatenate([np.arange(size), rare_owner]))
                zeros = np.zeros(len(rare_owner))
                names = [f" {x}" for x in doc.to_pylist()] + [key_of(index.words[i]) for i in rare_word.tolist()]
                cols = [
                    doc.take(at), pa.array(digest).take(at), pa.array(names, pa.string()),
                    pa.array(np.concatenate([np.zeros(size, np.int64), times])), pa.array(np.concatenate([np.ones(size), zeros]).astype(np.int64)),
                    pa.array(np.concatenate([tokens, zeros]).astype(np.int64)), pa.array(np.concatenate([seen, zeros]).astype(np.int64)),
                    pa.array(np.concatenate([logs, zeros])), pa.array(np.concatenate([cls, zeros])),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "digest", "word", "times", "docs", "n_tokens", "known", "logs", "cls"])
                if len(index) > INDEX:
                    index = Index(known.value)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, digest long, word string, times long, docs long, n_tokens long, known long, logs double, cls double"
    parts = rows.mapInArrow(task, schema)
    # rows of a document itself carry a word that no count has, so no key is hot
    joined = parts.join(counts.select("word", "n"), "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    by_doc = joined.groupBy("doc_id", "digest").agg(
        F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("logs") + F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum("cls").alias("cls"),
    )
    end_log, end_known = float(np.log10(texts + 1.0)), int(texts > 0)
    n = F.col("n_tokens") / F.col("docs")
    logs = F.col("logs") / F.col("docs") + F.lit(end_log)
    out = by_doc.select(
        "doc_id", held_out(F.col("doc_id"), *hold_out).alias("held_out"), n.cast("long").alias("n_tokens"),
        (F.col("known") / F.col("docs") + F.lit(end_known)).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - n * F.lit(float(np.log10(total + distinct + 1.0)))).alias("base_score"), (logs + F.col("cls") / F.col("docs")).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("docs"))).alias("_copy"),
    )
    return out.drop("_copy")
