"""Every registered query against its own SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
# the queries of the llm subpackage have tests of their own beside it
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in entry.queries().items() if not OWN.match(k)}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not OWN.match(k)}
# estimates have no statement that gives the same numbers; tests/test_rolling.py bounds their error
WITHOUT_SQL = {"rolling_users_sketch"}


@pytest.fixture(scope="session")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join Cross", "EvalPython", "MapInPandas"):
        assert bad not in plan, f"{bad} in the plan"
    if name in ORACLES:
        problems = [p for p in compare(df, ORACLES[name], con) if not p.startswith("warning")]
        assert not problems, problems
    else:
        assert df.count() > 0


def test_scan_reads_only_what_is_needed(spark):
    df = QUERIES["report_relative_days"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "ts:timestamp_ntz,user_id:bigint"


def test_day_filter_prunes_partitions(spark, warehouse):
    import datetime as dt

    from visitledger.config import Settings
    from visitledger.plans import gold

    silver = gold.Silver.of(warehouse, Settings())
    week = gold.vw_site_overview(silver, dt.date(2024, 1, 22), dt.date(2024, 1, 28))
    plan = week._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "city" not in scan.split("ReadSchema")[1] and "event_date" in plan


@pytest.mark.parametrize("name", ["panel_ranking", "panel_opens", "unmapped_targets", "weekly_dataset", "quality_gold_counts",
                                  "views_by_name", "bars_by_state"])
def test_no_job_runs_while_a_plan_is_built(spark, name):
    group = f"building {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        QUERIES[name](spark, SF)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
