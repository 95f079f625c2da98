"""Every SQL-checkable registered query equals its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as E
from thermocal.plans.registry import ORACLE
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
E.queries()  # fills the library's registry


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [c[0] for c in cur.description]
    sc, sr = canon(sdf.columns, srows)
    dc, dr = canon(dcols, cur.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Right_final" in df.columns
