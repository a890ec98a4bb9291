"""The registered queries against their DuckDB twins (the driver's gate, small)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tickerlake.plans.oracle import ORACLE
from tickerlake.plans.registry import QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
FILE_QUERIES = {"read_offset_csv", "read_sheets", "read_reordered_csv", "read_short_sheets", "initialize", "daily_update", "daily_tables",
                "read_listing"}  # see test_sources / test_store_jobs


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILE_QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Symbol", "Reference", "Open", "High", "Low", "Close", "Volume"]
    assert df.count() >= 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILE_QUERIES))
def test_no_python_in_plans(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", ["compare_lists", "rename_keys", "incremental_prices"])
def test_small_sides_are_broadcast_at_run_time(spark, name):
    """Static plans may pick sort-merge (a checkpointed side has no size
    estimate); AQE measures the small side and switches to a broadcast."""
    df = E.queries()[name](spark, SF)
    df.collect()  # runs this DataFrame's own query execution
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
