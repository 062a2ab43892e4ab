"""Every registered query against its SQL twin (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck, spark_pdf

SF = "/root/testdata/sf0.001"
SLOW = {"rf_train_score", "rf_holdout_metrics", "rf_stream_score"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query_matches_sql(spark, con, name):
    sp = spark_pdf(entry.queries()[name](spark, SF))
    ok, msg = compare(sp, con.execute(entry.oracle_sql()[name]).df())
    assert ok, msg


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.oracle_sql()])
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() >= 1


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["category"] for r in rows} == {"engagement", "conversion"}
