"""Manifest, MinHash and conversation repair against brute-force versions, on the small
table and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import manifest, minhash, queries, repair
from tests.conftest import SMALL
from tests.llm.test_llm_ops import ODD, rows

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd_docs(spark):
    data = [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in ODD]
    clash = ["key", "at", "n", "tree", "digest", "node", "row", "lefts", "piece", "path"]
    return spark.createDataFrame(data, DOCS).select("*", *[F.lit("x").alias(c) for c in clash])


# 11 manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(data):
    """data: (doc_id, source, lang, n_chars, text)."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def up(nodes, at, new):
        """Root, siblings of ``at``, root with ``new`` in its place."""
        siblings = ""
        while len(nodes) > 1:
            lo = at - at % 8
            run = nodes[lo : lo + 8]
            siblings += "".join(run[: at - lo] + run[at - lo + 1 :])
            new = sha("".join(run[: at - lo] + [new] + run[at - lo + 1 :]))
            nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
            at //= 8
        return nodes[0], siblings, new

    groups = defaultdict(list)
    for row in data:
        hit = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 3 == 0
        tampered = (*row[:4], row[4].translate(lower) if hit and row[4] is not None else row[4])
        groups[row[2]].append((row[0], sha("".join(map(enc, row))), sha("".join(map(enc, tampered)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    roots = [up([r[1] for r in groups[g]], 0, "")[0] for g in order]
    out = []
    for k, g in enumerate(order):
        for i, (doc_id, own, new) in enumerate(groups[g]):
            sub, below, folded = up([r[1] for r in groups[g]], i, new)
            root, above, folded = up(roots, k, folded)
            out.append((str(doc_id), own, sub, root, sha(below + above), folded, folded == root))
    return sorted(out)


def manifest_rows(df):
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((str(r["doc_id"]), *[r[c] for c in names]) for r in rows(df))


def test_manifest_matches_brute_force(spark, docs, odd_docs):
    assert manifest.manifest(odd_docs.limit(0)).count() == 0
    one = odd_docs.where("doc_id = 1")
    assert manifest_rows(manifest.manifest(one))[0][4] == sha("")
    for df in (docs, odd_docs, one):
        data = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
        got = manifest_rows(manifest.manifest(df))
        assert got == brute_manifest(data)
    assert {r[-1] for r in got} <= {True, False}


def test_manifest_over_several_tiers(spark):
    """Trees of more than two tiers, and many groups."""
    data = [(i, "s", None if i % 10 == 3 else "a" if i % 10 else f"l{i % 90:02d}", i, f"Text {i}") for i in range(700)]
    df = spark.createDataFrame(data, DOCS)
    assert manifest_rows(manifest.manifest(df, levels=1)) == brute_manifest(data)


def test_levels_retain_the_state_before_each_slot():
    level = manifest.Level([b"a", b"b", b"c"])
    for i, (state, left) in enumerate(zip(level.states, (b"", b"a", b"ab"))):
        assert state.hexdigest() == hashlib.sha256(left).hexdigest()
        assert level.left[i] == left and level.left[i] + [b"a", b"b", b"c"][i] + level.right[i] == b"abc"


# 12 MinHash


def brute_sets(data):
    out = []
    for i, t in data:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])))
    return out


def brute_similar(data):
    sets = brute_sets(data)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            if one and two and 5 * min(len(one), len(two)) >= 4 * max(len(one), len(two)) and 100 * len(one & two) >= 80 * len(one | two):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(s), str(least.get(find(k))), i == least.get(find(k))) for k, (i, s) in enumerate(sets))


def minhash_rows(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in rows(df))


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def family(rng, n, words, edits):
    """A text and copies of it with some words replaced."""
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = [" ".join(base)]
    while len(out) < n:
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"x{rng.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


def test_minhash_matches_brute_force(spark, docs, odd_docs):
    assert minhash.near_dedup(odd_docs.limit(0)).count() == 0
    for df in (docs, odd_docs):
        assert minhash_rows(minhash.near_dedup(df)) == brute_similar(pairs_of(df))


def test_minhash_on_loose_groups(spark, monkeypatch):
    """Groups whose members are not all similar to each other, once in blocks and with
    left keys dealt out by their right collections."""
    rng = random.Random(3)
    texts = family(rng, 150, 90, 9) + family(rng, 40, 60, 12) + family(rng, 6, 30, 3) + ["a b c d", "a b c d e", "A B c", "a b c", "x", "X", "y"]
    data = [(3 * i % 211, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = brute_similar(data)
    assert len({r[2] for r in want}) > 20
    assert minhash_rows(minhash.near_dedup(df)) == want
    monkeypatch.setattr(minhash, "GROUP", 10)
    monkeypatch.setattr(minhash, "BLOCK", 32)
    assert minhash_rows(minhash.near_dedup(df)) == want


def test_tables_meet_as_computed():
    """Share of sets of a known similarity that share a table, against the formula."""
    rng = np.random.default_rng(5)
    hits, trials, share = 0, 300, 0.5
    for _ in range(trials):
        both = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        a, b = (np.sort(np.concatenate([both, rng.integers(0, 1 << 63, 100, dtype=np.uint64)])) for _ in range(2))
        same = minhash.collections(a) == minhash.collections(b)
        hits += bool(same[0].any() and same[1].any())
    want = (1 - (1 - share**minhash.DEPTH) ** minhash.SIDE) ** 2
    assert abs(hits / trials - want) < 0.1


@pytest.mark.parametrize("name", ["op11_manifest", "op12_minhash"])
def test_queries_return_every_document(spark, docs, name):
    assert queries.QUERIES[name](spark, SMALL).count() == docs.count()


# 13 conversation repair


def brute_audit(initials, gone, cut):
    """All cheapest audits by value iteration over whole strings."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    give = (2, 2, 3, 2)

    def inserts(at):
        for _ in range(3):
            for q, (c, s) in list(at.items()):
                t, new = give[q], (c + 3, s + "I")
                if t not in at or new < at[t]:
                    at[t] = new
        return at

    at = inserts({0: (0, "")})
    for initial, lost, short in zip(initials, gone, cut):
        new = {}
        for q, (c, s) in at.items():
            options = [(q, (c + 4, s + "D"))]
            if not lost:
                options.append((give[q], (c + 3 + 3 * short, s + "R")))
                if (q, initial) in step:
                    options.append((step[q, initial], (c + 3 * short, s + "K")))
            for t, o in options:
                if t not in new or o < new[t]:
                    new[t] = o
        at = inserts(new)
    return min(at[q] for q in (0, 3) if q in at)


def brute_exhaustive(initials, gone, cut):
    """Every audit of up to four inserts, read against the grammar."""
    import itertools
    import re

    best, n = None, len(initials)
    for edits in itertools.product("KRD", repeat=n):
        if any(lost and e != "D" for e, lost in zip(edits, gone)):
            continue
        cost = sum({"K": 0, "R": 3, "D": 4}[e] + (3 if e != "D" and short else 0) for e, short in zip(edits, cut))
        for gaps in itertools.product(range(3), repeat=n + 1):
            if sum(gaps) > 4:
                continue
            audit = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
            total = cost + 3 * sum(gaps)
            if best is not None and (total, audit) >= best:
                continue
            # any role may stand for a given one
            slots = [["u", "a"]] * gaps[0]
            for i, e in enumerate(edits):
                slots += ([[initials[i]]] if e == "K" else [["u", "a"]] if e == "R" else []) + [["u", "a"]] * gaps[i + 1]
            if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in itertools.product(*slots)):
                best = (total, audit)
    return best


def test_audits_match_every_audit():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randint(0, 4)
        case = [rng.choice("suat") for _ in range(n)], [rng.random() < 0.2 for _ in range(n)], [rng.random() < 0.2 for _ in range(n)]
        want = brute_exhaustive(*case)
        assert brute_audit(*case) == want
        for modulus in ((1 << 61) - 1, 2, 3):  # with small ones hashes collide
            assert min(f for f in (repair.audits(*case, modulus=modulus)[q] for q in repair.FINAL) if f) == want


def test_long_audits_whole_and_in_pieces():
    rng = random.Random(8)
    for n in (30, 200):
        for modulus in ((1 << 61) - 1, 5):
            case = [rng.choice("sua") for _ in range(n)], [rng.random() < 0.1 for _ in range(n)], [rng.random() < 0.1 for _ in range(n)]
            want = brute_audit(*case)
            assert min(f for f in (repair.audits(*case, modulus=modulus)[q] for q in repair.FINAL) if f) == want
            cut = range(0, n, 7)
            pieces = [[repair.audits(*[c[i : i + 7] for c in case], start=q, modulus=modulus) for q in range(4 if i else 1)] for i in cut]
            assert repair.joined(pieces) == want


def test_longest_common_prefix():
    rng = random.Random(9)
    for modulus in ((1 << 61) - 1, 3):
        nodes = [repair.Node(None, "", modulus)]
        for _ in range(300):
            nodes.append(repair.Node(rng.choice(nodes[-40:]), rng.choice("KD"), modulus))
        for _ in range(500):
            a, b = rng.choice(nodes), rng.choice(nodes)
            one, two = a.audit(), b.audit()
            want = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
            assert repair.common_prefix(a, b) == want


def brute_repair(data):
    blanks = " \t\n\x0b\x0c\r"
    groups = {}
    for conv, turn, role, text in data:
        role, text = (" " if x is None else x for x in (role, text))
        own = groups.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if fate == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, kinds = set(), []
        for _, role, text in own:
            end = text.rstrip(blanks)
            kinds.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute_audit(initials, [k in ("b", "d") for k in kinds], [k == "t" for k in kinds])
        lines, rest = [], iter(own)
        for e in audit:
            _, role, text = (0, "", "") if e == "I" else next(rest)
            if e != "D":
                last = lines[-1][0][:1] if lines else ""
                lines.append((role if e == "K" else "assistant" if last == "u" else "user", text))
        digest = sha("\n".join(f"{r}:{t}" for r, t in lines))
        out.append((str(conv), gaps, *[kinds.count(k) for k in "bdt"], illegal, cost, audit, digest))
    return sorted(out)


TALK = "conv_id long, turn long, role string, text string"


def repair_rows(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((str(r["conv_id"]), *[r[c] for c in names]) for r in rows(df))


def odd_talk():
    rng = random.Random(11)
    data = [
        (1, None, "user", "No turn."), (1, 3, None, None), (1, 3, "assistant", "Ties."), (1, 3, "assistant", "Ties."), (None, 1, "user", "Nobody."),
        (None, None, None, None), (2, 0, "tool", "Odd role."), (2, 1, "", "No role."), (3, 5, "user", "x" * 50000), (3, 9, "assistant", "Wörter 東京!\r\n\x0b"),
        (4, 0, "system", " \t\n "), (5, 7, "user", None),
    ]
    data += [(6, t, rng.choice(["system", "user", "assistant"]), rng.choice(["Yes.", "No!", "Well", "", "Why?\n", f"Word {t}."])) for t in range(300)]
    return data + [(c, 0, "user", "Hi.") for c in range(20, 60)]


def test_repair_matches_brute_force(spark, monkeypatch):
    talk = spark.read.parquet(f"{SMALL}/conversations.parquet")
    clash = ["key", "place", "conv", "piece", "fate", "audit", "cost", "first", "_copy"]
    odd = spark.createDataFrame(odd_talk(), TALK).select("*", *[F.lit("x").alias(c) for c in clash])
    assert repair.repair(odd.limit(0)).count() == 0
    monkeypatch.setattr(repair, "PIECE", 40)  # the long conversation comes in pieces
    for df in (talk, odd):
        data = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
        assert repair_rows(repair.repair(df)) == brute_repair(data)


def test_repair_query_returns_every_conversation(spark):
    talk = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert queries.op13_repair(spark, SMALL).count() == talk.select("conv_id").distinct().count()
