"""Every query with an oracle equals its DuckDB twin (sf0.001; the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle_harness import compare

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_query_registered_with_callable():
    assert len(QUERIES) >= 100
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["query_id", "rank", "doc_id", "score", "source", "lang", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck.execute(ORACLES[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg
