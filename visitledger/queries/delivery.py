"""Delivered files through the whole load: completeness, overlaps, the control log and a rebuild."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FEEDS
from ..plans import load
from ..session import shared_dir
from ..sources import bronze, delivery, landed
from ..sources.tables import Warehouse
from ..streaming.landing import stream_landed
from . import dataset as d
from .oracle import SITE, money
from .registry import registered

FEED = FEEDS["usuarios"]
_GRAIN = ["event_date", "hostname", "device_category"]
_METRICS = ("sessions", "engaged_sessions", "user_engagement_seconds")


def _groups(spark, sf_dir) -> DataFrame:
    """One delivered row for each day, host and device, numbered by the host within the day."""
    groups = d.raw_events(spark, sf_dir).groupBy(*_GRAIN).agg(
        F.count("*").alias("sessions"), F.count_if("engaged").alias("engaged_sessions"),
        F.sum("engagement_s").alias("user_engagement_seconds"), F.count_distinct("user_id").alias("users"))
    day = Window.partitionBy("event_date")
    return groups.withColumn("host_no", F.dense_rank().over(day.orderBy("hostname"))).withColumn(
        "of_day", F.count("*").over(day))


_GROUPS_SQL = """SELECT *, dense_rank() OVER (PARTITION BY event_date ORDER BY hostname) AS host_no, count(*) OVER (PARTITION BY event_date) AS of_day
    FROM (SELECT event_date, hostname, device_category, count(*) AS sessions, count(*) FILTER (WHERE engaged) AS engaged_sessions,
            CAST(sum(cents) AS BIGINT) AS cents, count(DISTINCT user_id) AS users FROM raw_events GROUP BY ALL)"""


def _cells(factor: int = 1) -> dict[str, Column]:
    """Delivered text of each field of the feed; the counts are multiplied, so that one extraction differs from another."""
    many = lambda c: (F.col(c) * factor).cast("string")
    return {
        "date": F.date_format("event_date", "yyyyMMdd"), "hostName": F.col("hostname"), "country": F.lit(""),
        "deviceCategory": F.col("device_category"), "active1DayUsers": many("users"), "active7DayUsers": many("users"),
        "active28DayUsers": many("users"), "sessions": many("sessions"), "engagedSessions": many("engaged_sessions"),
        "userEngagementDuration": many("user_engagement_seconds"),
    }


def _pages(rows: DataFrame, declared: Column, factor: int = 1, bare: Column | None = None) -> DataFrame:
    """One JSON response for each (extraction, page) of ``rows``; where ``bare`` holds, without its last metric."""
    cells = _cells(factor)
    value = lambda names: F.array(*[F.struct(cells[n].alias("value")) for n in names])
    header = lambda names: F.array(*[F.struct(F.lit(n).alias("name")) for n in names])
    bare = F.lit(False) if bare is None else bare
    least = lambda of: F.when(bare, of(FEED.metrics[:-1])).otherwise(of(FEED.metrics))
    row = F.struct(value(FEED.dimensions).alias("dimensionValues"), least(value).alias("metricValues"))
    pages = rows.withColumn("declared", declared).withColumn("heads", least(header)).groupBy("extraction", "page").agg(
        F.collect_list(row).alias("rows"), F.first("declared").alias("rowCount"), F.first("heads").alias("metricHeaders"))
    return pages.select("extraction", "page", F.to_json(F.struct(
        header(FEED.dimensions).alias("dimensionHeaders"), "metricHeaders", "rows", "rowCount")).alias("body"))


def _deliver(pages: DataFrame, inbox: str) -> None:
    """A file for each page, as an extractor would leave them."""
    pages.repartition("extraction", "page").write.mode("append").partitionBy("extraction", "page").text(inbox)


@registered("landed_corrupt", f"""WITH g AS ({_GROUPS_SQL}), x AS (SELECT event_date, day(event_date) % 5 AS fault, max(host_no) AS pages, max(of_day) AS n,
      count(*) FILTER (WHERE host_no > 1) AS others FROM g GROUP BY ALL)
    SELECT strftime(event_date, '%Y%m%d') AS extraction, CAST(pages AS BIGINT) AS pages, CAST(CASE fault WHEN 1 THEN others ELSE n END AS BIGINT) AS "rows",
      CAST(CASE fault WHEN 1 THEN CASE WHEN pages > 1 THEN n END WHEN 3 THEN n + 1 WHEN 4 THEN n - 1 ELSE n END AS INT) AS declared,
      CASE fault WHEN 0 THEN 'whole' WHEN 1 THEN 'corrupt' WHEN 2 THEN 'headers' WHEN 3 THEN 'short' ELSE CASE WHEN n > 1 THEN 'surplus' ELSE 'whole' END END AS state
    FROM x""")
def landed_corrupt(spark, sf_dir):
    """A day is an extraction, a host a page. Of five days one has a truncated page, one a page without a metric, one
    declares a row too many and one a row too few."""
    fault = F.day("event_date") % 5
    rows = _groups(spark, sf_dir).withColumns({
        "extraction": F.date_format("event_date", "yyyyMMdd"), "page": F.col("host_no"), "fault": fault})
    declared = F.col("of_day") + F.when(fault == 3, 1).when(fault == 4, -1).otherwise(0)
    pages = _pages(rows, declared, bare=(fault == 2) & (F.col("host_no") == 1))
    cut = (F.col("page") == 1) & (F.substring("extraction", 7, 2).cast("int") % 5 == 1)
    body = F.when(cut, F.expr("left(body, CAST(length(body) / 2 AS INT))")).otherwise(F.col("body"))
    root = shared_dir(spark, "landed_corrupt")
    _deliver(pages.withColumn("body", body), f"{root}/inbox")
    wh = Warehouse(spark, f"{root}/tables")
    wh.create_all()
    delivery.stage(wh, FEED, landed.read_pages(spark.read, f"{root}/inbox"), "query")
    return delivery.reconciled(wh.log("pages")).drop("relatorio", "delivered_at")


def _overlapping(spark, sf_dir) -> Warehouse:
    """Three extractions that overlap, through the stream: two whole ones and half of the third in the first run, its
    other half in the second run. Their counts are once, twice and three times those of the events."""
    root = shared_dir(spark, "overlapping")
    wh = Warehouse(spark, f"{root}/tables")
    wh.create_all()
    day, rows = F.day("event_date"), _groups(spark, sf_dir)

    def extraction(name: str, chosen: Column, factor: int, page: Column) -> DataFrame:
        mine = rows.where(chosen).withColumns({"extraction": F.lit(name), "page": page})
        return _pages(mine.withColumn("of_all", F.count("*").over(Window.partitionBy("extraction"))), F.col("of_all"), factor)

    def run() -> None:
        stream_landed(wh, FEED, d.SETTINGS, f"{root}/inbox", f"{root}/checkpoint").awaitTermination()

    halves = F.when(F.col("device_category") == "desktop", 1).otherwise(2)
    third = extraction("third", day >= 25, 3, halves)
    _deliver(extraction("first", day <= 20, 1, F.lit(1)), f"{root}/inbox")
    _deliver(extraction("second", day >= 15, 2, F.lit(1)), f"{root}/inbox")
    _deliver(third.where("page = 2"), f"{root}/inbox")
    run()
    _deliver(third.where("page = 1"), f"{root}/inbox")
    run()
    return wh


_TIMES = "CASE WHEN day(event_date) >= 25 THEN 3 WHEN day(event_date) >= 15 THEN 2 ELSE 1 END"


@registered("overlapping_extractions", f"""SELECT event_date, hostname, {SITE} AS site, device_category, CAST(users * {_TIMES} AS BIGINT) AS dau,
      CAST(sessions * {_TIMES} AS BIGINT) AS sessions, CAST(engaged_sessions * {_TIMES} AS BIGINT) AS engaged_sessions, {money(f'cents * {_TIMES}', 'user_engagement_seconds')}
    FROM ({_GROUPS_SQL})""")
def overlapping_extractions(spark, sf_dir):
    """Silver after the stream: each day has the rows of its newest whole extraction, once."""
    return _overlapping(spark, sf_dir).silver(FEED.table).select(*_GRAIN, "site", "dau", *_METRICS)


@registered("control_log", f"""WITH g AS ({_GROUPS_SQL}), x AS (SELECT unnest([(1, 20), (15, 31), (25, 31)]) AS span)
    SELECT 'usuarios' AS relatorio, 'incremental' AS tipo_carga, min(event_date) AS data_inicio_janela, max(event_date) AS data_fim_janela,
      CAST(count(DISTINCT event_date) AS INT) AS qtd_dias, count(*) AS qtd_linhas
    FROM x JOIN g ON day(event_date) BETWEEN span[1] AND span[2] GROUP BY span""")
def control_log(spark, sf_dir):
    """One line for each of the three extractions, none for a batch that only brought half of one."""
    return _overlapping(spark, sf_dir).control().drop("executado_em")


@registered("full_rebuild", f"""SELECT event_date, hostname, replace({SITE}, 'Outros', 'Fora') AS site, device_category,
      CAST(users * CASE WHEN day(event_date) >= 20 THEN 2 ELSE 1 END AS BIGINT) AS dau,
      CAST(sessions * CASE WHEN day(event_date) >= 20 THEN 2 ELSE 1 END AS BIGINT) AS sessions
    FROM ({_GROUPS_SQL})""")
def full_rebuild(spark, sf_dir):
    """Two snapshots of the last days, a load, then everything again under a changed rule, twice."""
    wh = Warehouse(spark, shared_dir(spark, "full_rebuild"))
    wh.create_all()
    rows = _groups(spark, sf_dir)
    fields = lambda factor: [c.alias(n) for n, c in _cells(factor).items()]
    bronze.append_snapshot(wh, FEED, rows.select(*fields(1)), dt.datetime(2024, 1, 31, 6))
    load.refresh_silver(wh, FEED, d.SETTINGS)
    bronze.append_snapshot(wh, FEED, rows.where("day(event_date) >= 20").select(*fields(2)), dt.datetime(2024, 1, 31, 18))
    for _ in range(2):
        load.rebuild_silver(wh, FEED, replace(d.SETTINGS, other_site="Fora"))
    if load.refresh_silver(wh, FEED, d.SETTINGS):
        raise AssertionError("a rebuilt table still has pending days")
    return wh.silver(FEED.table).select(*_GRAIN, "site", "dau", "sessions")
