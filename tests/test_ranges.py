"""Ranges of days: what is read, and that the result is that of the whole history."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitledger.config import Settings
from visitledger.functions.dates import Week, reference_week
from visitledger.operators.rolling import (
    daily_user_sketches, rolling_active_users, rolling_active_users_sketch, rolling_from_sketches,
)
from visitledger.plans import weekly
from visitledger.plans.gold import Silver
from visitledger.queries import load_all

SF = "/root/testdata/sf0.001"
SUN = dt.date(2024, 1, 28)
QUERIES = load_all()[0]


def plan(df):
    """The plan before execution, where no scan is reused yet."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths and filters
    try:
        return df._jdf.queryExecution().sparkPlan().toString()
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")


def scans(df, name):
    return [line for line in plan(df).splitlines() if "FileScan" in line and re.search(rf"/{name}[\],/]", line)]


def activity(spark, seed):
    rnd = random.Random(seed)
    day = dt.date(2024, 1, 1)
    rows = [(rnd.choice("ab"), rnd.randrange(8), day + dt.timedelta(days=rnd.randrange(80)), 1) for _ in range(150)]
    return spark.createDataFrame(rows, "k string, user_id int, event_date date, n bigint")


@pytest.mark.parametrize("seed", range(3))
def test_a_range_is_cut_from_the_whole(spark, seed):
    df = activity(spark, seed)
    for start, until in ((dt.date(2024, 2, 1), dt.date(2024, 2, 20)), (dt.date(2024, 3, 25), dt.date(2024, 4, 30))):
        inside = F.col("event_date") >= F.lit(start)
        whole = rolling_active_users(df, ["k"], sums=("n",), until=until).where(inside)
        part = rolling_active_users(df, ["k"], sums=("n",), until=until, start=start)
        assert sorted(map(tuple, part.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
        about = rolling_active_users_sketch(df, ["k"], until=until, start=start)
        counts = ["k", "event_date", "users_1d", "users_7d", "users_28d"]
        assert sorted(map(tuple, about.select(counts).collect())) == sorted(map(tuple, part.where("users_28d > 0").select(counts).collect()))


def test_sketches_of_several_loads_merge(spark, warehouse):
    df = activity(spark, 9)
    split = dt.date(2024, 2, 10)
    for part in ("event_date < '2024-02-10'", "event_date >= '2024-02-10'"):
        for _ in range(2):  # a load that is repeated replaces its days
            warehouse.store_sketches("k", daily_user_sketches(df.where(part), ["k"]))
    stored = warehouse.sketches("k", T.StructType([T.StructField("k", T.StringType())]))
    got = rolling_from_sketches(stored, ["k"], until=SUN + dt.timedelta(days=60), start=split)
    want = rolling_active_users(df, ["k"], until=SUN + dt.timedelta(days=60), start=split)
    columns = ["k", "event_date", "users_1d", "users_7d", "users_28d"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert "PartitionFilters: [isnotnull(event_date" in plan(got)


@pytest.mark.parametrize("name", ["closed_week_users", "weekly_site_kpis", "weekly_change", "weekly_daily_users", "weekly_devices",
                                  "weekly_top_countries", "weekly_top_states", "weekly_panels", "weekly_dataset"])
def test_weekly_queries_read_their_days(spark, name):
    found = scans(QUERIES[name](spark, SF), "events.parquet")
    assert found and all(re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,202[34]-[^\]]*LessThan\(ts,2024-01-29", s) for s in found)


def test_one_scan_for_each_fact(warehouse):
    found = plan(weekly.weekly_dataset(Silver.of(warehouse, Settings()), SUN))
    for table in ("ga4_eventos", "ga4_usuarios", "ga4_paginas"):
        lines = [x for x in found.splitlines() if "FileScan" in x and f"/{table}/" in x]
        assert len(lines) == 1 and "event_date" in lines[0].split("PartitionFilters")[1].split("ReadSchema")[0]  # no folders yet, so not a partition


def test_whole_result_agrees_with_its_sections(spark):
    from visitledger.queries import dataset

    silver = dataset.silver(spark, SF)
    rows = {(r["section"], r["member"], r["week_end"], r["kpi"]): r["value"] for r in weekly.weekly_dataset(silver, SUN).collect()}
    of = lambda section: {k[1:]: v for k, v in rows.items() if k[0] == section}
    assert of("country") == {(r["country"], SUN, "wau"): r["wau"] for r in weekly.top_countries(silver, SUN).collect()}
    assert of("state") == {(r["state"], SUN, "sessoes"): r["sessoes"] for r in weekly.top_states(silver, SUN).collect()}
    assert of("device") == {(r["device"], SUN, "wau"): r["wau"] for r in weekly.devices(silver, SUN).collect()}
    theme = weekly.top_theme(silver, SUN).first()
    assert of("theme") == {(theme["tema"], SUN, "share"): theme["share"]}
    assert len(of("panel")) == 2 * weekly.panel_week(silver, SUN).count()


def test_absent_sites_and_weeks_are_zeros(warehouse):
    silver = Silver.of(warehouse, Settings())
    kpis = weekly.site_kpis(silver, SUN).collect()
    assert {(r["site"], r["week_end"]) for r in kpis} == {(s, SUN - dt.timedelta(days=n)) for s in ("Dados", "Institucional") for n in (0, 7)}
    assert all(r["wau"] == r["sessoes"] == r["dau_medio"] == r["tempo_sessao"] == 0 for r in kpis)
    assert [r["phrase"] for r in weekly.site_change(weekly.site_kpis(silver, SUN), SUN).collect()] == ["sem semana anterior para comparar"] * 2
    result = weekly.weekly_dataset(silver, SUN).collect()
    assert {r["section"] for r in result} == {"site", "day"} and not any(r["value"] for r in result)


def test_the_gate(warehouse):
    silver = Silver.of(warehouse, Settings())
    closed = weekly.closed_week_dataset(silver, SUN)  # nothing runs yet
    with pytest.raises(Exception, match="week of 2024-01-28 is incomplete: ga4_eventos: missing_days, ga4_usuarios: missing_days"):
        closed.collect()
    assert weekly.closed_week_dataset(silver, SUN, force=True).count() == weekly.weekly_dataset(silver, SUN).count()


def test_the_gate_opens(spark):
    from visitledger.queries import dataset

    silver = dataset.silver(spark, SF)
    assert weekly.closed_week_dataset(silver, SUN).count() == weekly.weekly_dataset(silver, SUN).count()


def test_weeks():
    for n in range(800):
        day = dt.date(2023, 12, 20) + dt.timedelta(days=n)
        week = Week.of(day)
        assert week.monday.weekday() == 0 and week.monday <= day <= week.sunday == week.monday + dt.timedelta(days=6)
        last = reference_week(day)
        assert last.sunday < day <= last.sunday + dt.timedelta(days=7) and reference_week(day, last.sunday) == last
