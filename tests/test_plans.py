"""Physical-plan checks: no Python on SQL-checkable paths; row-wise operators never shuffle."""

import pytest

import __spark_entry__ as E
from thermocal.plans.registry import ORACLE

E.queries()  # fills the library's registry

SF = "/root/testdata/sf0.001"
ROW_WISE = ["read_project", "array_input", "poly_score_d1", "poly_score_d2", "poly_expand_d2", "poly_csv_view",
            "sigmoid_weight", "blend", "te_single_apply", "te_single_update", "te_multi_apply",
            "te_multi_update", "te_bracket", "standardize", "log10_target", "pow10_inverse"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_checked_queries_stay_in_the_jvm(spark, name):
    plan = _plan(spark, name)
    assert not any(node in plan for node in PYTHON_NODES), plan


@pytest.mark.parametrize("name", ROW_WISE)
def test_row_wise_queries_do_not_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "Exchange" not in plan, plan


def test_metrics_is_one_partial_aggregate(spark):
    plan = _plan(spark, "metrics_many")
    assert plan.count("Exchange") == 1  # only the one-row final merge
    assert "partial_count" in plan or "partial_sum" in plan
