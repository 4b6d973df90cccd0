"""Each operator against a brute-force version, on the small table and on awkward
rows: null and empty texts, null ids and columns, very long texts, ties, repeated
rows, an empty table and extra columns with clashing names."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import exact, maxent, mixing, packing, pii, quality, queries, simhash, tokens, urls, warc
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet, consectetur " * 3000
ODD = [
    (1, "plain words in a short text", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, LONG, "de", "a"),
    (5, "plain words in a short text", "en", "b"),
    (5, "plain words in a short text", "en", "b"),
    (None, "text without an id, contact me@x.org", "fr", "b"),
    (7, "9" * 30000 + " " + "a" * 30000, "en", None),
    (8, "don't you'll we've <|endoftext|>  two  spaces\n\n\n\ttabs été ñandú 東京 😀 the end ", "en", "a"),
    (9, " \t\n\x0b\x0c\r ", "en", "a"),
    (10, "plain  words in a\tshort text", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    clash = ["word", "n", "fp", "_t", "_run", "kept", "bucket", "piece", "_w", "best"]
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


# 1 token counts


def test_counts_match_the_library(spark, docs, odd, empty, tokenizer):
    assert tokens.count_tokens(empty, queries.vocabulary(), 1024).count() == 0
    for df in (docs, odd):
        want = sorted((str(i), len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs(df))
        got = rows(tokens.count_tokens(df, queries.vocabulary(), 1024))
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def test_every_prefix_count_is_exact(tokenizer):
    c = tokens.PrefixCounter(queries.vocabulary())
    rng = random.Random(1)
    bits = ["the", " ", "  ", "\n", "'re", "'ll", "'", "é", "東", "<|endoftext|>", "<|end", "word", "123", "!", "\t", "ing", "\xa0", "\x1c", "😀", "a", "'s"]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        want = [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert c.table(text).tolist() == want, repr(text)


def test_splitter_classes_agree_with_the_library(tokenizer):
    """The fast splitter is used for characters on which both agree."""
    c = tokens.PrefixCounter(queries.vocabulary())
    for code in (*range(0x20), *range(0x20, 0x250)):
        text = f"a{chr(code)} {chr(code)}1 b{chr(code)}{chr(code)}'s"
        assert sum(c.totals(tokens.split_units(text))) == len(tokenizer.encode(text, add_special_tokens=False).ids), hex(code)


def test_truncation_reads_the_table(spark, docs, tokenizer):
    got = {r["doc_id"]: r for r in rows(tokens.count_tokens(docs, queries.vocabulary(), 50, with_table=True))}
    for i, t in pairs(docs.limit(40)):
        n = got[i]["fit_chars"]
        assert len(tokenizer.encode(t[:n], add_special_tokens=False).ids) <= 50
        table = np.frombuffer(got[i]["prefix_counts"], "<i4")
        assert len(table) == len(t) + 1 and table[-1] == got[i]["n_tokens"]
        assert n == np.flatnonzero(table <= 50)[-1]


# 2 language-model scores


def brute_base(data):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    toks = lambda t: (t or "").encode().lower().split() + [None]
    seen = Counter(w for i, t in data if not held(i) for w in toks(t))
    total, distinct = sum(seen.values()), len(seen)
    return total, [
        (str(i), held(i), len(toks(t)), sum(seen[w] > 0 for w in toks(t)), round(sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in toks(t)), 4))
        for i, t in data
    ]


def test_base_scores_match_brute_force(spark, docs, odd, empty, monkeypatch):
    assert maxent.score_texts(empty).count() == 0
    monkeypatch.setattr(maxent, "FREQUENT", 100)  # most words take the join
    for df in (docs, odd):
        total, want = brute_base(pairs(df))
        got = rows(maxent.score_texts(df))
        assert {r["train_tokens"] for r in got} == {total}
        assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == sorted(want)


def test_model_beats_base_on_held_out_texts(spark):
    got = rows(maxent.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] <= 0 for r in got)


def test_probabilities_of_parts_sum_to_one():
    w = np.random.default_rng(0).normal(size=((1 << 10) + maxent.WIDTH, maxent.WIDTH)).astype(np.float32)
    f = np.random.default_rng(1).integers(0, 1 << 32, (3, 50), dtype=np.uint32)
    leaves = [0, *range(maxent.WIDTH, maxent.WIDTH**2)]  # the end has no parts
    total = sum(np.exp(maxent.leaf_log_probability(w, f, np.full(50, leaf, np.uint8))) for leaf in leaves)
    assert np.allclose(total, 1, atol=1e-4)


def test_update_is_the_gradient_step():
    rng = np.random.default_rng(2)
    w = rng.normal(size=((1 << 5) + maxent.WIDTH, maxent.WIDTH)).astype(np.float32)
    f = rng.integers(0, 1 << 32, (3, 40), dtype=np.uint32)
    leaf = np.where(rng.random(40) < 0.2, 0, rng.integers(maxent.WIDTH, maxent.WIDTH**2, 40)).astype(np.uint8)
    m, bias, y, _ = maxent.decisions(f, leaf, 5)
    gradient, met = np.zeros(w.shape), np.zeros(len(w), int)
    for d in range(len(y)):  # every decision by itself
        touched = [*m[:, d], (1 << 5) + bias[d]]
        z = w[touched].astype(float).sum(axis=0)
        g = np.exp(z) / np.exp(z).sum()
        g[y[d]] -= 1
        for k in touched:
            gradient[k] += g
            met[k] += 1
    energy = 1 + (gradient**2).mean(axis=1)
    want = w - gradient * (maxent.RATE / np.sqrt(energy))[:, None]
    seen, kept = np.zeros(len(w), np.int64), np.ones(len(w), np.float32)
    maxent.update(w, seen, kept, f, leaf)
    assert np.allclose(w, want, atol=1e-4) and np.allclose(kept, energy, rtol=1e-4) and (seen == met).all()


def test_weights_grow_with_the_corpus_up_to_their_bound():
    sizes = [maxent.bits_for(n) for n in (0, 10**5, 10**6, 10**7, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == maxent.MIN_BITS and 1 << sizes[-1] == maxent.MAX_BUCKETS
    assert sizes[1] < sizes[2] < sizes[3] and maxent.bits_for(10**12, 1 << 20) == 20


def test_mean_of_weights_is_by_times_met(spark):
    def part(block, buckets, n, value):
        w = np.full((len(buckets), maxent.WIDTH), value, np.float16)
        return pa.RecordBatch.from_pylist([{"block": block, "bucket": np.array(buckets, np.uint16).tobytes(), "n": np.array(n, np.uint32).tobytes(), "w": w.tobytes()}])

    got = maxent.mean_weights(iter([part(2, [1, 5], [1, 3], 1.0), part(2, [5], [1], 5.0), part(0, [7], [2], -1.0)]))
    means = {r["bucket"]: r["w"] for b in got for r in b.to_pylist()}
    assert {k: v[0] for k, v in means.items()} == {2049: 1.0, 2053: 2.0, 7: -1.0}


def test_scores_match_the_model_word_by_word(spark, docs, odd, monkeypatch):
    kept = {}
    real = maxent.train

    def train(*args):
        kept["w"] = real(*args)
        return kept["w"]

    monkeypatch.setattr(maxent, "train", train)
    monkeypatch.setattr(maxent, "FREQUENT", 100)
    for df in (docs, odd):
        data = pairs(df)
        got = Counter((str(r["doc_id"]), round(r["score"], 3)) for r in rows(maxent.score_texts(df)))
        held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        toks = lambda t: (t or "").encode().lower().split() + [b""]
        counts = Counter(x for i, t in data if not held(i) for x in toks(t))
        index = maxent.Index({})
        index[b""] = 0
        for x in counts:
            index[x]
        index.fill()
        mass = Counter({leaf: 1 for leaf in range(maxent.WIDTH**2)})
        for x, n in counts.items():
            mass[int(index.leaf[index[x]])] += n + (x != b"")
        want = Counter()
        for i, t in data:
            score, ids = 0.0, [1, 1, *(index[x] for x in toks(t))]
            index.fill()
            places = np.arange(2, len(ids))
            f = maxent.features(index.hash[ids], places)
            for k, place in enumerate(places):
                leaf = index.leaf[ids[place] : ids[place] + 1]
                log = float(maxent.leaf_log_probability(kept["w"], f[:, k : k + 1], leaf)[0]) / math.log(10)
                score += log + math.log10((counts[index.words[ids[place]]] + 1) / mass[int(leaf[0])])
            want[str(i), round(score, 3)] += 1
        for (i, score), n in want.items():
            assert sum(c for (j, other), c in got.items() if j == i and abs(other - score) < 0.02 + 1e-5 * abs(score)) >= n


def test_part_of_word_from_its_bytes():
    words = ["a", "ab", "abc", "longer", "été", "ñ", "東京"]
    index = maxent.Index({})
    numbers = {w: index[w.encode()] for w in words}
    index.fill()
    for w, i in numbers.items():
        b = w.encode()
        assert index.leaf[i] == (zlib.crc32(b[-3:]) % 15 + 1) * 16 + (zlib.crc32(b[:4]) >> 8) % 16


def test_long_words_in_every_text_are_known_to_the_tasks(spark):
    line = "=" * 500
    df = spark.createDataFrame([(i, f"w{i} {line} x {line}") for i in range(60)], "doc_id long, text string")
    total, want = brute_base(pairs(df))
    got = rows(maxent.score_texts(df))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == sorted(want)
    counts = {r["word"]: r["n"] for r in rows(maxent.word_counts(df))}
    assert counts[maxent.key_of(line.encode())] == 120 and all(len(w.encode()) <= 65 for w in counts)


def test_hashes_by_bytes_equal_those_by_word(odd, docs):
    assert [len(x) for x in maxent.sequences(pa.array([], pa.string()))] == [0, 0, 0]
    texts = [t or "" for _, t in pairs(odd) + pairs(docs)] + ["", "", " a", "b ", "x", "\tA\x0bB\x0c", "", "é É\u00a0z"]
    column = pa.array(["left out", *texts])
    for a, b in ((0, len(texts)), (3, 9), (len(texts) - 8, len(texts))):
        index = maxent.Index({})
        ids, _ = maxent.numbers(texts[a:b], index)
        h, leaf, places = maxent.sequences(column.slice(a + 1, b - a))
        assert (index.hash[ids] == h).all() and (index.leaf[ids] == leaf).all() and (places == np.flatnonzero(ids != 1)).all()


# 3 personal data


def luhn_ok(d):
    s = [int(c) for c in reversed(d)]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(s)) % 10 == 0


def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn_ok(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


HARD = [
    "a@b.c_d@e.f x@y.z%q@r.s a@b.c@d.e .@-.- mail me@x.org", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.04 1..2.3.4.5 12.3.4.5678",
    "4111 1111 1111 1111 and 4111-1111-1111-1111- 94111111111111111999 4111  1111 1111 1111 5 5", "+1 (602) 555-0417 +12 +1234567890123456 ++49.89.123456-7) +1.2.3.4.5.6.7.8.9.0",
    "é 😀 +1 (602) 555-0417 ñ 10.0.0.1 ü a.b@c.de 4111111111111111", "7" * 2000 + " 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "a" * 3000 + "@" + "b" * 3000 + ".c",
]


def test_base_spans_match_brute_force(spark, docs, odd, empty):
    assert pii.find(empty).count() == 0
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (docs, odd, hard):
        got = rows(pii.find(df).select("doc_id", pii.spans_text(F.col("base_spans")).alias("b"), pii.spans_text(F.col("spans")).alias("s")))
        want = sorted((str(i), brute_spans(t or "")) for i, t in pairs(df))
        assert sorted((str(r["doc_id"]), r["b"]) for r in got) == want
        assert all(set(r["b"].split(",")) <= set(r["s"].split(",")) for r in got)


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 ok", "IBAN DE88 3704 0044 0532 0130 00", "my SSN is 123-45-6789", "part 123-45-6789"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [x["kind"] for x in r["spans"]] for r in rows(pii.find(df))}
    assert got == {0: ["iban"], 1: [], 2: ["ssn"], 3: []}


def test_card_scores_rise_with_context(spark):
    df = spark.createDataFrame([(0, "credit card 4111111111111111"), (1, "number 4111111111111111")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"][0]["score"] for r in rows(pii.find(df))}
    assert got[0] > got[1]


# 4 SimHash


def brute_print(t, n=4):
    w = [x.encode() for x in WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))]
    sh = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, bits):
    """prints: (doc_id, fp); smallest doc_id by component."""
    fps = sorted({f for _, f in prints})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for d, f in prints:
        if d is not None:
            least[find(f)].append(d)
    return sorted((str(d), f"{f:016x}", str(min(least[find(f)], default=None))) for d, f in prints)


def test_simhash_matches_brute_force(spark, docs, odd, empty):
    assert simhash.near_dedup(empty).count() == 0
    for df in (docs, odd):
        want = brute_components([(i, brute_print(t)) for i, t in pairs(df)], 4)
        got = rows(simhash.near_dedup(df).select("doc_id", simhash.hex_print(F.col("fp")).alias("f"), "component_id"))
        assert sorted((str(r["doc_id"]), r["f"], str(r["component_id"])) for r in got) == want


def test_grid_join_loses_no_link(spark, monkeypatch):
    """Chains and clouds of fingerprints, with blocks and the forest in use."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "SMALL", 4)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, 4).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    def groups(links):
        root = {f: f for f in fps}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            root[find(a)] = find(b)
        out = defaultdict(set)
        for f in fps:
            out[find(f)].add(f)
        return sorted(map(sorted, out.values()))
    every = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4]
    assert groups(edges) == groups(every)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# 5 quality


def brute_quality(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), n < 20 or 100 * len(cover) > 30 * n


def test_quality_counts_match_brute_force(spark, docs, odd, empty):
    assert quality.judge(empty).count() == 0
    twice = "one two three four five six seven eight nine ten eleven twelve "
    extra = spark.createDataFrame([(1, twice * 2 + "x"), (2, "a " * 30), (3, twice * 3), (4, "a\n" * 5 + " a\n\n\n" * 3)], "doc_id long, text string")
    for df in (docs, odd, extra):
        cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        got = sorted((str(r["doc_id"]), *(r[c] for c in cols)) for r in rows(quality.judge(df)))
        assert got == sorted((str(i), *brute_quality(t)) for i, t in pairs(df))


def test_quality_keeps_clean_and_drops_junk(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where(~F.col("base_failed"))
    by = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert by[1] > 0.99 and by[0] < 0.3, by


# 6 packing


def check_packing(got, data, tokenizer, limit=1024):
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in data}
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.asarray(part, "<u4").tobytes()) == r["ids_crc32"] and len(part) == r["length"] <= limit
    by_seq = defaultdict(list)
    for r in got:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    want = Counter(sum(([(i, p, len(ids[i]))] for i, _ in data for p in range(-(-len(ids[i]) // limit))), []))
    assert Counter((r["doc_id"], r["piece"], len(ids[r["doc_id"]])) for r in got) == want
    return sum(r["length"] for r in got) / limit / len(by_seq)


def test_packing_is_whole_and_dense(spark, docs, odd, empty, tokenizer):
    assert packing.pack(empty, queries.vocabulary()).count() == 0
    assert check_packing(rows(packing.pack(docs, queries.vocabulary())), pairs(docs), tokenizer) > 0.9
    check_packing(rows(packing.pack(odd, queries.vocabulary(), open_bins=2)), pairs(odd), tokenizer)


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert fit.add(6, ("a",)) == [] and fit.add(7, ("b",)) == []
    assert fit.add(8, ("c",)) == [("b", 1, 0)]  # three bins would be open: the fullest closes
    assert fit.add(4, ("d",)) == [("a", 0, 0), ("d", 0, 6)]  # best fit, then full


def test_only_the_first_piece_is_shorter():
    ids = np.arange(25, dtype="<u4").tobytes()
    assert [(p, s, len(b) // 4) for p, s, b in packing.cut(ids, 10)] == [(0, 0, 5), (1, 5, 10), (2, 15, 10)]
    assert [(p, s, len(b) // 4) for p, s, b in packing.cut(ids[:40], 10)] == [(0, 0, 10)]


# 7 web archives


def b32(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def brute_warc(data):
    body = [(i, (h or "").encode()) for i, h in data]
    least = {}
    for i, b in body:
        least[b] = min(i, least.get(b, i))
    return sorted((i, len(b), b32(b), "response" if least[b] == i else "revisit", None if least[b] == i else least[b]) for i, b in body)


def test_archives_round_trip(spark, tmp_path):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    nasty = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\n"
    pages += [(1000, nasty), (1001, nasty), (1002, None), (1003, ""), (1004, "é😀" * 20000), (1005, pages[0][1])]
    df = spark.createDataFrame([(i, None if i == 1001 else f"http://h/{i}", h, 1) for i, h in pages], "page_id long, url string, html string, body int")
    path = warc.scratch(spark)
    warc.write_pages(df, path, per_file=20)
    got = rows(warc.resolve(warc.assemble(warc.read_records(spark, path))))
    cols = ["capture_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(tuple(r[c] for c in cols) for r in got) == brute_warc(pages)
    whole = rows(warc.assemble(warc.read_records(spark, path, with_payload=True)))
    kept = {r["metadata"][0]["fields"]["capture-id"]: r["capture"]["payload"] for r in whole if r["capture"]["type"] == "response"}
    assert kept["1000"].decode() == nasty and kept["1004"].decode() == "é😀" * 20000
    assert all([x["concurrent_to"] for x in r["request"]] == [[r["capture"]["record_id"]]] for r in whole)
    assert {r["url"] is None for r in got if r["capture_id"] == 1001} == {True}


def test_archives_of_nothing_and_of_null_ids(spark):
    for data in ([], [(None, None, None), (None, "u", "a")]):
        path = warc.scratch(spark)
        warc.write_pages(spark.createDataFrame(data, "page_id long, url string, html string"), path)
        got = rows(warc.resolve(warc.assemble(warc.read_records(spark, path))))
        assert [r["record_type"] for r in got] == ["response"] * len(data)


def record(kind, i, *to):
    return (kind, i and f"<{i}>", None, [f"<{x}>" for x in to] or None, None, None, None, None, None, None)


def transactions(spark, *records):
    got = rows(warc.assemble(spark.createDataFrame(list(records), warc.RECORD)))
    ids = lambda xs: "".join(x["record_id"].strip("<>") for x in xs)
    return {(r["capture"]["record_id"] or "").strip("<>"): (ids(r["request"]), ids(r["metadata"])) for r in got}


def test_transactions_follow_links_both_ways_to_the_end(spark):
    got = transactions(
        spark, record("response", "a"), record("request", "b", "a"), record("metadata", "c", "b"), record("metadata", "d", "c"), record("metadata", "e", "zz"),
        record("response", "p", "q", "zz"), record("request", "q", "r"), record("metadata", "r"), record("metadata", "s", "q", "q", "r"),
        record("revisit", "u"), record("request", None, "u"), record("request", "v"), record("response", None, "w"), record("metadata", "w"),
    )
    assert got == {"a": ("b", "cd"), "p": ("q", "rs"), "u": ("", ""), "": ("", "")}


def test_transactions_with_several_captures(spark):
    got = transactions(
        spark, record("response", "a", "b"), record("revisit", "b", "a"), record("request", "c", "b", "a"), record("metadata", "d", "b"),
        record("metadata", "e", "d"), record("metadata", "f", "e", "c"), record("request", "g", "f"), record("request", "c", "a"),
    )
    # f is as near to a (by c) as e is to b (by d); g hangs on f
    assert got == {"a": ("ccg", "f"), "b": ("", "de")}
    assert transactions(spark, record("request", "x", "y"), record("metadata", "y", "x")) == {}


def test_transactions_in_a_long_chain_and_on_one_record(spark):
    chain = [record("response", "m0")] + [record("metadata", f"m{i}", f"m{i - 1}") for i in range(1, 6)]
    many = [record("response", "h")] + [record("request", f"r{i:03d}", "h") for i in range(200)]
    got = rows(warc.assemble(spark.createDataFrame(chain + many, warc.RECORD)))
    assert sorted((len(r["request"]), [x["record_id"] for x in r["metadata"]]) for r in got) == [(0, [f"<m{i}>" for i in range(1, 6)]), (200, [])]


def archive(blocks):
    return [b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(b)) + b + b"\r\n\r\n" for i, b in enumerate(blocks)]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_archives_are_read_in_pieces(monkeypatch, piece):
    import gzip

    monkeypatch.setattr(warc, "PIECE", piece)
    blocks = [b"", b"x" * 50, b"\r\n\r\nWARC/1.1\r\n\r\n", bytes(range(256)) * 4]
    records = archive(blocks)
    for data in (b"".join(records), gzip.compress(b"".join(records)), b"".join(gzip.compress(r) for r in records), b"".join(records)[:-4]):
        got = list(warc.parse(data))
        assert [b for _, b in got] == blocks and [h["warc-record-id"] for h, _ in got] == [[f"<{i}>"] for i in range(4)]
    assert list(warc.parse(b"")) == []
    for bad in (b"".join(records)[:-20], b"none", records[1][:30]):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_repeated_headers_are_kept():
    head = b"WARC/1.0\r\nWARC-Concurrent-To: <a>\r\nwarc-concurrent-to: <b>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert next(warc.parse(head))[0]["warc-concurrent-to"] == ["<a>", "<b>"]


# 8 mixing


def test_raked_weights_meet_all_margins(spark, docs):
    rows_ = mixing.measured(docs, "doc_id", "text", "source", "lang")
    cells = rows_.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0").toPandas()
    df = spark.createDataFrame(cells)
    got = mixing.rake(df, mixing.MARGINS).toPandas()
    total = cells.tokens.sum()
    for name, alpha in mixing.MARGINS.items():
        t = cells.groupby(name).tokens.sum() / total
        target = t**alpha / (t**alpha).sum() * total
        assert np.allclose(got.groupby(name).weight.sum()[target.index], target, rtol=0.01), name
    w = cells.tokens.to_numpy(float)
    for _ in range(200):
        for name, alpha in mixing.MARGINS.items():
            t = cells.groupby(name).tokens.sum() / total
            target = t**alpha / (t**alpha).sum() * total
            w = w * (target / cells.assign(w=w).groupby(name).w.sum())[cells[name]].to_numpy()
    key = list(mixing.MARGINS)
    both = got.merge(cells.assign(w=w), on=key)
    assert np.allclose(both.weight, both.w, rtol=0.02)


def test_mixing_keeps_the_calibrated_share(spark, docs, odd, empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd).count() == len(ODD)
    got = mixing.mix(docs).toPandas()
    assert len(got) == docs.count()
    assert abs((got.probability * got.n_tokens).sum() / got.n_tokens.sum() - mixing.KEEP_SHARE) < 0.01
    assert got.probability.between(0, 1).all()
    assert 0 < got.kept.sum() < len(got)


def test_mixing_matches_brute_force(spark, docs):
    """Weights, factor, probability, draw and copies of every document."""
    bound = 2
    got = {r["doc_id"]: r for r in rows(mixing.mix(docs, max_copies=bound))}
    texts = dict(pairs(docs))
    cell = {i: (r["source"], r["lang"], r["topic"]) for i, r in got.items()}
    size = {i: len(WORD.findall(texts[i] or "")) for i in got}
    assert size == {i: r["n_tokens"] for i, r in got.items()}
    tokens_ = Counter()
    for i, c in cell.items():
        tokens_[c] += size[i]
    tokens_ = {c: n for c, n in tokens_.items() if n}
    total, weight = sum(tokens_.values()), dict(tokens_)

    def sums(values, at):
        out = Counter()
        for c, n in values.items():
            out[c[at]] += n
        return out

    targets = []
    for at, alpha in enumerate(mixing.MARGINS.values()):
        t = {v: (n / total) ** alpha for v, n in sums(tokens_, at).items()}
        targets.append({v: x / sum(t.values()) * total for v, x in t.items()})
    for _ in range(300):
        for at, target in enumerate(targets):
            now = sums(weight, at)
            weight = {c: w * target[c[at]] / now[c[at]] for c, w in weight.items()}
    ratio = {c: weight[c] / n for c, n in tokens_.items()}
    low, high = 0.0, 1e6
    for _ in range(200):
        k = (low + high) / 2
        low, high = (k, high) if sum(n * min(1, k * ratio[c]) for c, n in tokens_.items()) < mixing.KEEP_SHARE * total else (low, k)
    for i, r in got.items():
        expected = min(k * ratio.get(cell[i], 1.0), bound)
        draw = int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) / (1 << 60)
        assert abs(r["probability"] - min(1, expected)) < 0.01
        if min(abs(draw - expected % 1), abs(expected - round(expected))) > 0.01:
            assert r["copies"] == math.floor(expected) + (draw < expected % 1) <= bound
        assert r["kept"] == (r["copies"] > 0) and r["gap"] <= mixing.TOLERANCE


def test_mixing_reports_targets_that_cannot_be_met(spark):
    """Two cells that share no margin value: no weights meet both margins."""
    df = spark.createDataFrame([(i, "a b c " * 9, "en", "x") for i in range(20)] + [(99, "a b", "de", "y")], SCHEMA)
    gap = mixing.mix(df).first()["gap"]
    assert gap > mixing.TOLERANCE


def test_mixing_meets_the_targets_with_a_hot_source(spark):
    """Half of all tokens from one source: the kept tokens still have the target shares."""
    df = spark.range(12000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.lit(20)).alias("text"), F.when(F.col("id") % 3 == 0, "de").otherwise("en").alias("lang"),
        F.when(F.col("id") < 6000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    got = mixing.mix(df).toPandas()
    copied = got.n_tokens * got.copies
    total = got.n_tokens.sum()
    for name in ("source", "lang"):
        t = got.groupby(name).n_tokens.sum() / total
        target = t ** mixing.MARGINS[name] / (t ** mixing.MARGINS[name]).sum()
        share = copied.groupby(got[name]).sum() / copied.sum()
        assert np.allclose(share[target.index], target, rtol=0.06), (name, share, target)
    assert (got.kept == (got.copies > 0)).all() and got.copies.max() > 1
    assert abs((got.probability * got.n_tokens).sum() / total - mixing.KEEP_SHARE) < 0.01


# 9 URL filters


def brute_host_path(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def brute_rule(host, path):
    fits = []
    for r in queries.URL_RULES:
        h, _, p = r.prefix.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r.prefix), r.prefix, r.verdict))
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(spark):
    urls_ = [
        "http://A.Example.ORG/es/1?x=/fr/", "https://example.org/en/1", "https://x.example.org/en/2", "ftp://com/fr/", "http://a.com", "http://a.com#/fr/",
        "no scheme", "", None, "://org/", "http://Éa.org/", "http://notorg/", "http://b.com/de/x#y", "http://b.net/fr/", "a://b://c.org/", "http://x.org?q", "x" * 50000 + "://a.org/b",
    ]
    data = [(i, u) for i, u in enumerate(urls_)] + [(r["page_id"] + 100, r["url"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    df = spark.createDataFrame([(i, u, 1, 2) for i, u in data], "page_id long, url string, key int, host int")
    got = {r["page_id"]: r for r in rows(urls.judge_urls(df, queries.URL_RULES))}
    assert len(got) == len(data)
    for i, u in data:
        host, path = brute_host_path(u)
        rule, verdict = brute_rule(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] in (("allow", "block") if verdict is None else (verdict,))


def test_model_follows_the_rules_it_was_trained_on(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.judge_urls(pages, queries.URL_RULES).where("rule is not null")
    sep = {r["verdict"]: r["m"] for r in got.groupBy("verdict").agg(F.avg("score").alias("m")).collect()}
    assert sep["allow"] > sep["block"]


def test_url_probabilities_sum_to_one_over_the_alphabet(spark):
    df = spark.createDataFrame([("ab", True), ("abc", True), ("ba", False)], "text string, good boolean")
    t = urls.train(df)
    counts = {r["g"]: (r["a"], r["ca"]) for r in t[0].collect()}
    assert counts == {"a": (2, 5), "b": (2, 5), "c": (1, 5)}
    got = {r["g"]: (r["a"], r["ca"]) for r in t[1].collect()}
    assert got["ab"] == (2, 2) and got["bc"] == (1, 1)


def test_rare_url_grams_stay_in_the_model_of_a_large_table(spark):
    data = [("axb", False), ("xa", False), ("abx", None), ("qxé", None)] + [("ab" * 50, True)] * 2500
    tables = urls.train(spark.createDataFrame(data, "text string, good boolean"))
    assert {r["g"]: (r["a"], r["b"]) for r in tables[0].collect()}["x"] == (0, 2)
    counts = Counter()
    for text, good in data:
        p = "^" * urls.ORDER + text
        for e in range(urls.ORDER, len(p)):
            for k in range(urls.ORDER + 1):
                if good is not None:
                    counts[good, k, p[e - k : e + 1]] += 1
                    counts[good, k, "context", p[e - k : e]] += 1

    def p_of(good, gram):
        p = 1 / urls.ALPHABET
        for k in range(urls.ORDER + 1):
            g = gram[len(gram) - k - 1 :]
            p = (counts[good, k, g] + urls.WEIGHT * p) / (counts[good, k, "context", g[:-1]] + urls.WEIGHT)
        return p

    texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(data)], "number long, text string")
    got = {r["number"]: r["score"] for r in rows(urls.scored(texts, urls.likelihoods(tables)))}
    for i, (t, _) in enumerate(data[:5]):
        p = "^" * urls.ORDER + t
        want = [math.log(p_of(True, p[e : e + urls.ORDER + 1])) - math.log(p_of(False, p[e : e + urls.ORDER + 1])) for e in range(len(t))]
        assert abs(got[i] - sum(want) / len(want)) < 1e-9, t


def test_urls_without_training_are_allowed(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, None), (2, None)], "page_id long, url string")
    assert [r["verdict"] for r in rows(urls.judge_urls(df, queries.URL_RULES))] == ["allow"] * 3
    assert urls.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


# 10 exact duplicates


def brute_exact(data):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]", "", t or ""), len(t or "")) for i, t in data]
    groups = defaultdict(list)
    for i, n, c in norm:
        groups[n].append((-c, i is None, i if i is not None else 0))
    out = []
    for i, n, _ in norm:
        _, null, k = min(groups[n])
        keep = None if null else k
        out.append((str(i), str(keep), len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("runs,fan", [(256, 16), (7, 3)])
def test_exact_matches_brute_force(spark, docs, odd, empty, runs, fan):
    assert exact.dedup(empty).count() == 0
    for df in (docs, odd):
        got = rows(exact.dedup(df, runs=runs, fan=fan))
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got) == brute_exact(pairs(df))


def test_packing_encoder_equals_the_library_on_whole_texts():
    import random

    import numpy as np
    from tokenizers import Tokenizer

    from corpusmill.llm import packing, queries

    e, library = packing.Encoder(queries.vocabulary()), Tokenizer.from_file(queries.vocabulary())
    rng = random.Random(5)
    parts = ["a", "B", "é", "Ǆ", "9", " ", "\n", "\n\n", "\t", "'", "'s", ".", "?!", "_", "<|endoftext|>", "<|", "́", "中", "½", " ", "😀", "ɏ", "\x1c"]
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(64)] + ["ab" * 500 + ".\nx"]
        got = [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_reads_the_vocabulary_by_rank():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    e, library = packing.Encoder(path), Tokenizer.from_file(path)
    assert e.ranks is not None
    blocks = [range(0x20, 0x3100), range(0xA000, 0xA100), range(0xFF00, 0x10000), range(0x1F300, 0x1F400)]
    texts = [f"a{chr(c)} {chr(c)}1 b{chr(c)}{chr(c)}'s\n{chr(c)}" for block in blocks for c in block]
    texts += [" " * 2_000_000 + "x", "a" * 200_000, "<|endoftext|>" * 3]  # the first is too long a run for the fast splitter
    for text, got in zip(texts, e.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:20]
    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.ranks is None
    want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Some words, here", add_special_tokens=False).ids
    assert np.frombuffer(other.encode(["Some words, here"])[0], "<u4").tolist() == want
