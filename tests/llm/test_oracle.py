"""The SQL-checkable training-data queries equal their DuckDB twins (sf0.001), and the native ones stay in the JVM."""

import pytest

from thermocal.llm.queries import ORACLE, QUERIES
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
NATIVE = ["op6_secret_scan", "op10_line_templates"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "PythonUDF")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), plan
