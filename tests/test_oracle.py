"""Every registered query of the warehouse operators against its DuckDB oracle (the driver's check), at sf0.001 for speed."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck
from wharf.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    r = compare(spark, con, name, E.queries()[name], sql, SF)
    assert r["cols_match"] and r["hash_match"] and r["rows"][0] == r["rows"][1], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["route", "n"] and {r.route for r in rows} == {"page", "start", "err", "display", "action", "quarantine"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_query_plan(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, (name, node)
