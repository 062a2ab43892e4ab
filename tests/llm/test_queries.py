"""Every registered query against its SQL twin, and the driver's contract."""

import pytest

import __spark_entry__ as entry
from kestrel.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare, duck, spark_pdf

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql_twin(spark, name):
    ok, why = compare(spark_pdf(QUERIES[name](spark, SF)), duck(SF).execute(ORACLE_SQL[name]).df())
    assert ok, why


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op3_secret_scans"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
