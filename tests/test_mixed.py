"""M3 on mixed columns."""

from pyspark.sql import functions as F

from corpusmill.operators import classify as cl
from corpusmill.operators import evaluate as ev
from corpusmill.operators import features as fx
from corpusmill.plans import model_queries as mq
from tests.conftest import MID


def test_auc_on_lineitem_and_labels(spark):
    assert mq.mixed_lineitem_auc(spark, MID).first()[0] > 0.95
    assert mq.mixed_quality_auc(spark, MID).first()[0] > 0.6


def test_every_kind_of_column_is_used(spark):
    """Each column alone tells the classes apart; missing and unreadable values are allowed."""
    rows = [(i, i % 2, str(float(i % 2)), "ab"[i % 2], f"x;{'pq'[i % 2]}", f"word {'good bad'.split()[i % 2]}", f"2024-0{i % 2 + 1}-1{i % 9}") for i in range(200)]
    rows += [(900, None, None, None, None, None, None), (901, 1, "n/a", "", "", "", "no date")]
    df = spark.createDataFrame(rows, "id long, y int, num string, cat string, many string, text string, day string")
    kinds = {"num": fx.Numerical((0.0, 1.0), 4), "cat": fx.Categorical(), "many": fx.Categorical(delimiter=";"), "text": fx.Text(word_n=2, char_k=3), "day": fx.Date()}
    for name, kind in kinds.items():
        m = cl.fit_mixed(df, fx.FeatureSpec({name: kind}, "y"), 64, (), 5)
        got = cl.predict_mixed(m, df.drop("y"), ["id"])
        assert got.count() == len(rows)
        found = got.where("id < 900").select((F.col("pred") == F.col("id") % 2).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
        assert found == 1.0, name
    both = cl.fit_mixed(df, fx.FeatureSpec(kinds, "y"), 256, [("cat", "many")], 5)
    scored = cl.predict_mixed(both, df, ["id", "y"]).where("id < 900")
    assert ev.roc_auc(scored, "p1", "y").first()[0] == 1.0


def test_the_names_of_places_stay_out_of_the_fit(spark):
    """A wide fit carries no list of its places' names through its iterations."""
    import time

    df = spark.createDataFrame([(i, i % 2, f"word {'good bad'.split()[i % 2]}") for i in range(40)], "id long, y int, text string")
    start = time.time()
    cl.fit_mixed(df, fx.FeatureSpec({"text": fx.Text(word_n=2)}, "y"), 1 << 18, (), 15)
    assert time.time() - start < 40
