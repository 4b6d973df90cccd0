"""Hand-made inputs for what the driver tables do not contain: personal data
kinds, tag alignment, spans, link reach, JSON / text readers, edge cases."""

import json
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import classify as cl
from corpusmill.operators import features as fx
from corpusmill.operators import index as ix
from corpusmill.operators import reform as rf
from corpusmill.operators import tagging as tg
from corpusmill.operators import vectors as vx
from corpusmill.plans.registry import load
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources import files, html
from tests.conftest import MID, SMALL


def scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def local(path):
    """Python file IO needs the plain path of a local ``file:`` URI (tests run locally)."""
    return path[len("file:"):] if path.startswith("file:") else path


# Invented values; card numbers and IBANs pass their check digits.
PII_TEXT = (
    "Mail ann.lee@example.org or call +1 (555) 123-4567. Card 4111 1111 1111 1111, CVV 123. "
    "Bad card 4111 1111 1111 1112. SSN 123-45-6789. Born 1990-04-12 and 3/7/2001. "
    "IBAN GB82 WEST 1234 5698 7654 32. Passport No. X1234567. Driving licence number DL-99812. "
    "Met Dr. Jane Smith in NATION_3."
)


def test_pii_kinds_in_rule_order(spark):
    df = spark.createDataFrame([(1, PII_TEXT)], "doc_id long, text string")
    gaz = spark.createDataFrame([("NATION_3",)], "name string")
    finds = {(r["kind"], r["value"]) for r in tg.detect_pii(df, "doc_id", "text", gaz).collect()}
    assert ("EMAIL", "ann.lee@example.org") in finds
    assert ("CARD", "4111 1111 1111 1111") in finds
    assert not any(v == "4111 1111 1111 1112" for k, v in finds if k == "CARD")  # fails Luhn
    assert ("SSN", "123-45-6789") in finds
    assert ("DATE", "1990-04-12") in finds and ("DATE", "3/7/2001") in finds
    assert ("IBAN", "GB82 WEST 1234 5698 7654 32") in finds
    assert ("CARD_CODE", "CVV 123") in finds
    assert any(k == "PASSPORT" for k, _ in finds)
    assert any(k == "DRIVING_LICENCE" for k, _ in finds)
    assert ("NAME", "Dr. Jane Smith") in finds
    assert ("LOCATION", "NATION_3") in finds
    assert any(k == "PHONE" for k, _ in finds)


def test_redact_masks_in_order(spark):
    df = spark.createDataFrame([(1, "card 4111111111111111 phone 555-123-4567")], "doc_id long, text string")
    out = tg.redact(df).first()["text"]
    assert out == "card [CARD] phone [PHONE]"


def test_empty_and_null_text(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert tg.detect_pii(df).count() == 0
    idx = ix.build_index(df)
    assert idx.n_docs == 2 and idx.postings.count() == 0
    q = spark.createDataFrame([(1, "anything")], "query_id long, text string")
    assert ix.search(idx, q, 5).count() == 0  # no hits, no error


def test_all_ties_break_by_id_and_k_above_n(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(5)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "words")], "query_id long, text string")
    hits = ix.search(ix.build_index(docs), q, 50).orderBy("rank").collect()
    assert [h["doc_id"] for h in hits] == [0, 1, 2, 3, 4]


def test_align_tags_rejects(spark):
    df = spark.createDataFrame(
        [(1, "John lives here", "B-PER O O"), (2, "too short", "O"), (3, "bad tag", "O B-XYZ")],
        "row_id long, source string, target string",
    )
    good, bad = fx.align_tags(df, "row_id", "source", "target", ["B-PER", "I-PER"], "O")
    assert good.count() == 3
    assert {(r["row_id"], r["reason"]) for r in bad.collect()} == {(2, "length"), (3, "unknown_tag")}


def test_bio_spans(spark):
    rows = [(1, i, t) for i, t in enumerate(["B-PER", "I-PER", "O", "I-LOC", "B-LOC", "B-PER"])]
    df = spark.createDataFrame(rows, "row_id long, pos long, tag string")
    spans = sorted((r["kind"], r["start"], r["end"]) for r in tg.bio_spans(df).collect())
    assert spans == [("LOC", 3, 3), ("LOC", 4, 4), ("PER", 0, 1), ("PER", 5, 5)]


def test_tagger_learns_and_fine_tunes_new_tag(spark):
    a = spark.createDataFrame([(1, 0, "Alice", "B-PER"), (1, 1, "runs", "O")], "row_id long, pos long, token string, tag string")
    b = spark.createDataFrame([(2, 0, "Paris", "B-LOC"), (2, 1, "sleeps", "O")], "row_id long, pos long, token string, tag string")
    m = tg.fine_tune_tagger(tg.fit_tagger(a), b)
    t = spark.createDataFrame([(9, 0, "Paris"), (9, 1, "Alice")], "row_id long, pos long, token string")
    got = {r["pos"]: r["tag"] for r in tg.tag(m, t, 1).collect()}
    assert got == {0: "B-LOC", 1: "B-PER"}


def test_unknown_class_words_use_prior(spark):
    tr = spark.createDataFrame([(1, "good good", "a"), (2, "bad", "b"), (3, "good", "a")], "id long, text string, y string")
    m = cl.fit_text(tr, "id", "text", "y")
    p = cl.predict(m, spark.createDataFrame([(9, "zzz unseen")], "id long, text string"), "id", "text", 2).orderBy("rank").collect()
    assert p[0]["label"] == "a"  # prior 2/3 wins when no word is known


def test_examples_jsonl_keeps_bad_lines(spark):
    path = scratch(spark, "jsonl")
    os.makedirs(local(path))
    with open(f"{local(path)}/x.jsonl", "w") as f:
        f.write(json.dumps({"prompt": "p", "context": "c", "target": "t"}) + "\n")
        f.write("{not json\n")
    good, bad = files.read_examples_jsonl(spark, path)
    assert [tuple(r) for r in good.collect()] == [("p", "c", "t")]
    assert bad.count() == 1


def test_read_lines_and_json_records(spark):
    path = scratch(spark, "txt")
    os.makedirs(local(path))
    with open(f"{local(path)}/a.txt", "w") as f:
        f.write("one\ntwo\n")
    assert [r["line"] for r in files.read_lines(spark, path).collect()] == ["one", "two"]
    with open(f"{local(path)}/r.json", "w") as f:
        json.dump([{"label": "x1", "abstract": "A"}, {"label": "x2", "abstract": "B"}], f)
    recs = files.read_json_records(spark, f"{path}/r.json", "label")
    assert sorted((r["key"], r["abstract"]) for r in recs.collect()) == [("x1", "A"), ("x2", "B")]


def test_csv_round_trip_tab(spark):
    path = scratch(spark, "tsv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline', "en")], "doc_id long, text string, lang string")
    files.write_table(df, path, sep="\t")
    back = files.read_corpus_csv(spark, path, "doc_id long, text string, lang string", sep="\t")
    assert back.collect() == df.collect()


def test_link_reach_on_linked_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://s.example/a", '<a href="/b">b</a><a href="c">c</a>'),
            (2, "http://s.example/b", '<a href="http://s.example/d">d</a>'),
            (3, "http://s.example/c", ""),
            (4, "http://s.example/d", '<a href="/a">a</a>'),
            (5, "http://s.example/e", ""),
        ],
        "page_id long, url string, html string",
    )
    starts = spark.createDataFrame([(1,)], "start long")
    got = {(r["page_id"], r["depth"]) for r in html.link_reach(pages, starts, 2).collect()}
    assert got == {(1, 0), (2, 1), (3, 1), (4, 2)}
    got0 = {(r["page_id"], r["depth"]) for r in html.link_reach(pages, starts, 0).collect()}
    assert got0 == {(1, 0)}


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_reformulate_matches_brute_force(spark):
    """Brute force over all targets sharing a 3-gram: nearest by edit distance, ties by text."""
    from corpusmill.plans.graph_queries import _reform

    noisy, hits = _reform(spark, SMALL, 3)
    targets = [r["title"] for r in html.html_to_corpus(load(spark, SMALL, "pages")).select("title").distinct().collect()]

    def grams(s):
        s = s.lower()
        return {s} if len(s) <= 3 else {s[i : i + 3] for i in range(len(s) - 2)}

    tg_ = {t: grams(t) for t in targets}
    want = set()
    for r in noisy.collect():
        qg = grams(r["query"])
        cand = sorted((_lev(r["query"], t), t) for t in targets if tg_[t] & qg)
        for rank, (d, t) in enumerate(cand[:3], 1):
            want.add((r["query_id"], t, rank, d))
    got = {(r["query_id"], r["target"], r["rank"], r["distance"]) for r in hits.collect()}
    assert got == want


def test_knn_matches_numpy(spark):
    e = load(spark, SMALL, "embeddings")
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in vx.knn(e, e, 3).collect()}
    rows = e.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    m = np.array([r["embedding"] for r in rows], dtype=np.float64)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(m @ m.T, 6)
    np.fill_diagonal(s, -np.inf)
    for i, qid in enumerate(ids):
        order = np.lexsort((ids, -s[i]))[:3]
        for rank, j in enumerate(order, 1):
            assert got[(qid, rank)] == ids[j]


@pytest.mark.parametrize("sf", [SMALL])
def test_linear_model_learns_quality(spark, sf):
    from corpusmill.plans.model_queries import linear_quality_auc

    auc = linear_quality_auc(spark, MID).first()["roc_auc"]
    assert auc > 0.5


def test_viterbi_uses_transitions(spark):
    # "I-PER" only ever follows "B-PER": an ambiguous word after a B-PER word decodes as I-PER.
    rows = []
    for r in range(20):
        rows += [(r, 0, "Anna", "B-PER"), (r, 1, "Lee", "I-PER"), (r, 2, "lee", "O"), (r, 3, "runs", "O")]
    m = tg.fit_tagger(spark.createDataFrame(rows, "row_id long, pos long, token string, tag string"))
    t = spark.createDataFrame([(1, 0, "Anna"), (1, 1, "Lee"), (1, 2, "runs")], "row_id long, pos long, token string")
    got = [r["tag"] for r in tg.decode(m, t).orderBy("pos").collect()]
    assert got == ["B-PER", "I-PER", "O"]


def test_knn_approx_recall_above_half(spark):
    e = load(spark, MID, "embeddings")
    exact = vx.knn(e, e, 10)
    approx = vx.knn_approx(e, e, 10)
    from corpusmill.operators import evaluate as ev

    assert ev.recall_at_k(approx, exact.select("query_id", "doc_id"), 10).first()[0] > 0.5


def test_containment_truth_short_and_long_items(spark):
    docs = spark.createDataFrame(
        [(1, "the quick brown fox jumps"), (2, "xquick brownish"), (3, "nothing here")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(10, "quick brown"), (11, "k brown fox ju"), (12, "own"), (13, "zzz")], "item_id long, text string")
    got = sorted(tuple(r) for r in ix.containing_docs(ix.build_index(docs), docs, items).collect())
    assert got == [(10, 1), (10, 2), (11, 1), (12, 1), (12, 2)]
