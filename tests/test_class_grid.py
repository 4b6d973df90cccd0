"""Scoring any number of classes: the blocks against the in-row plan and numpy."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corpusmill.operators import class_grid
from corpusmill.operators import classify as cl
from tests.test_crossed import shuffled


def brute(train, rows, k):
    docs, length, counts = Counter(), Counter(), defaultdict(Counter)
    for label, text in train:
        docs[label] += 1
        for w in text.split():
            length[label] += 1
            counts[w][label] += 1
    v, n, out = len(counts), sum(docs.values()), []
    for i, text in rows:
        known = [w for w in text.split() if w in counts]
        score = {c: math.log(docs[c] / n) - len(known) * math.log(length[c] + v) for c in docs}
        for w in known:
            for c, m in counts[w].items():
                score[c] += math.log(m + 1)
        score = {c: round(s, 4) for c, s in score.items()}
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]
        z = sum(math.exp(s - best[0][1]) for s in score.values())
        out += [(i, c, s, round(math.exp(s - best[0][1]) / z, 6), r) for r, (c, s) in enumerate(best, 1)]
    return sorted(out)


def near(got, want):
    got = sorted(tuple(r) for r in got.select("row_id", "label", "score", "prob", "rank").collect())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a[0], a[1], a[4]) == (b[0], b[1], b[4]) and abs(a[2] - b[2]) < 2e-4 and abs(a[3] - b[3]) < 2e-6


def test_blocks_equal_brute_force_and_the_row_plan(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    train = [(f"c{min(int(rng.expovariate(0.15)), 29):02d}", " ".join(rng.choices(words, k=rng.randint(0, 8)))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices([*words, "unseen"], k=rng.randint(0, 12)))) for i in range(60)]
    model = cl.fit_text(spark.createDataFrame([(i, *r) for i, r in enumerate(train)], "id long, label string, text string"), "id", "text", "label")
    df = spark.createDataFrame(rows, "id long, text string")
    want = brute(train, rows, 3)
    near(cl.predict(model, df, "id", "text", 3), want)
    monkeypatch.setattr(cl, "IN_ROW_CLASSES", 5)
    near(cl.predict(model, df, "id", "text", 3), want)
    monkeypatch.setattr(class_grid, "CLASSES", 7)  # several blocks of classes and rows
    monkeypatch.setattr(class_grid, "TERMS", 50)
    near(cl.predict(model, df, "id", "text", 3), want)
    assert cl.predict(model, df.limit(0), "id", "text").count() == 0


def test_a_hundred_thousand_classes(spark):
    n = 100_000
    base = spark.range(n).select(F.col("id").alias("i"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("label"))
    text = F.concat_ws(" ", F.concat(F.lit("x"), F.col("i").cast("string")), F.lit("common"), F.concat(F.lit("g"), (F.col("i") % 500).cast("string")))
    model = cl.fit_text(base.withColumn("text", text), "i", "text", "label")
    rows = spark.createDataFrame([(1, "x777 common"), (2, "g499 x499"), (3, "nothing known"), (4, None)], "id long, text string")
    got = {r["row_id"]: (r["label"], r["score"]) for r in cl.predict(model, rows, "id", "text").collect()}
    v = n + 1 + 500
    assert got[1][0] == "c777" and abs(got[1][1] - (math.log(1 / n) + 2 * math.log(2) - 2 * math.log(3 + v))) < 2e-4
    assert got[2][0] == "c499" and got[3][0] == got[4][0] == "c0"


def test_tabular_rows_of_many_classes(spark, monkeypatch):
    data = [(f"k{i % 9}", i % 9, i % 2) for i in range(90)]
    df = spark.createDataFrame(data, "label string, a long, b long")
    feats = {"a": F.col("a"), "b": F.col("b")}
    model = cl.fit_tabular(df, feats, "label")
    rows = lambda d: sorted((r["a"], r["b"], r["label"], round(r["score"], 3), round(r["prob"], 5), r["rank"]) for r in d.collect())
    want = rows(cl.predict_tabular(model, df, ["a", "b"], feats, 2))
    monkeypatch.setattr(cl, "IN_ROW_CLASSES", 3)
    assert rows(cl.predict_tabular(model, df, ["a", "b"], feats, 2)) == want and len(want) == 180


def test_catalogue_text_to_id(spark):
    shop = spark.createDataFrame([(7, "red running shoes", "light shoes for long runs"), (8, "blue socks", "warm wool socks"), (9, None, "")], "id long, title string, body string")
    asked = spark.createDataFrame([(1, "wool socks"), (2, "shoes for running")], "q long, text string")
    got = {r["row_id"]: r["label"] for r in cl.predict(cl.cold_start(shop, "id", "title", "body"), asked, "q", "text").collect()}
    assert got == {1: "8", 2: "7"}


def test_prediction_as_a_column(spark):
    train = spark.createDataFrame([(1, "good fine", "a"), (2, "bad awful", "b")], "id long, text string, label string")
    rows = [(1, "fine", 7), (1, "fine", 7), (None, None, 8), (2, "awful bad unseen", 9)]
    df = spark.createDataFrame(rows, "id long, text string, label long").withColumn("a.b", F.lit(1)).withColumn("_row", F.lit(2))
    got = cl.predicted(cl.fit_text(train, "id", "text", "label"), df, "text", "best")
    assert got.columns == [*df.columns, "best"]
    assert sorted((str(r["id"]), r["label"], r["best"]["label"]) for r in got.collect()) == [("1", 7, "a"), ("1", 7, "a"), ("2", 9, "b"), ("None", 8, "a")]
    assert cl.predicted(cl.fit_text(train, "id", "text", "label"), df.limit(0), "text").count() == 0


def test_more_blocks_shuffle_no_more(spark, monkeypatch):
    """Blocks of classes and of rows meet without being shuffled once for each other."""
    rng = random.Random(7)
    text = lambda: " ".join(rng.choices([f"w{i}" for i in range(400)], k=8))
    model = cl.fit_text(spark.createDataFrame([(i, f"c{i}", text()) for i in range(500)], "id long, label string, text string"), "id", "text", "label")
    df = spark.createDataFrame([(i, text()) for i in range(500)], "id long, text string").cache()
    find = lambda: cl.predict(model, df, "id", "text", 2)
    met = []
    for classes, terms in ((100, 1000), (10, 100)):
        monkeypatch.setattr(class_grid, "CLASSES", classes)
        monkeypatch.setattr(class_grid, "TERMS", terms)
        met.append(shuffled(spark, find))
    (rows, few), (again, many) = met
    assert [r[:2] for r in again] == [r[:2] for r in rows] and len(rows) == 1000 and many < 4 * few
