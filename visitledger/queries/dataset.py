"""The given tables seen as report feeds, so that every view and check can run on them whole.

Raw events are first reduced to one row per (day, user, device, browser, event, name) with counts. A user with a third
of all events is then a handful of rows per day before anything is shuffled by user.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import WINDOW_DAYS, RobotRule, Settings
from ..functions.dates import instant
from ..functions.text import or_not_set
from ..functions.traffic import site_of
from ..functions.url import redirect_target
from ..operators.rolling import rolling_active_users
from ..operators.segments import flag_by_window
from ..schemas import DIMENSIONS, SILVER

SETTINGS = Settings(robots=RobotRule(min_sessions=2, min_engaged_pct=45), home_country="ASIA")

# How columns of the given tables stand in for report dimensions (plain SQL, valid in both engines).
HOST = """CASE user_id % 5 WHEN 0 THEN 'data.example.org' WHEN 1 THEN 'WWW.example.org' WHEN 2 THEN 'example.org'
          WHEN 3 THEN 'example-org.translate.test' ELSE 'localhost' END"""
DEVICE = "CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE '' END"
BROWSER = "CASE user_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' ELSE '' END"
SYSTEM = "CASE user_id % 2 WHEN 0 THEN 'Windows' ELSE 'Android' END"
EVENT = """CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'click' THEN 'user_engagement'
           WHEN 'view' THEN 'page_view' WHEN 'purchase' THEN 'painel_acessado' ELSE 'painel_clicado' END"""
PANEL_NAME = "CASE WHEN event_id % 30 = 0 THEN '' ELSE concat('Brand#', CAST(event_id % 30 AS STRING)) END"
CITY = "CASE WHEN user_id % 7 < 3 THEN c_mktsegment ELSE '' END"
REGION = "CASE WHEN n_nationkey % 8 = 7 THEN '' ELSE concat('State of ', n_name) END"
BRAND_NO = "CAST(substr(p_brand, 7) AS INT)"
PAGE = """concat('https://data.example.org/relatorios/?redirect=', CASE event_id % 5
            WHEN 0 THEN concat('https://bi.example/view?r=', replace(translate(b64, '+/', '-_'), '=', ''))
            WHEN 1 THEN concat('https%3A%2F%2Fbi.example%2Fview%3Fr%3D', replace(b64, '=', '%3D'))
            WHEN 2 THEN concat('https%253A%252F%252Fbi.example%252Fview%253Fr%253D', replace(b64, '=', '%253D'))
            WHEN 3 THEN 'tutorial.php'
            ELSE CASE WHEN event_id % 10 = 4 THEN 'contato.php'
                      ELSE concat('https://bi.example/view?r=', substr(b64, 1, length(b64) - 3)) END END)"""

#: Days before a span whose users still count in it.
LOOKBACK = max(WINDOW_DAYS) - 1
FEED_GRAIN = ["event_date", "hostname", "country", "region", "city", "device_category"]


# Columns of the given tables that are read here (no schema is inferred from files).
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    """Last day with any event, as a scalar that reads one column."""
    return table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).scalar()


class Span(NamedTuple):
    """Days to read, both included; an open end is None."""

    start: dt.date | None = None
    end: dt.date | None = None

    def reaching_back(self, days: int) -> Span:
        return self._replace(start=self.start and self.start - dt.timedelta(days=days))


ALL = Span()


def raw_events(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    """Events with report dimensions that need no other table. The span is a filter on the file's own time column."""
    events = table(spark, sf_dir, "events")
    if span.start:
        events = events.where(F.col("ts") >= instant(dt.datetime.combine(span.start, dt.time())))
    if span.end:
        events = events.where(F.col("ts") < instant(dt.datetime.combine(span.end + dt.timedelta(days=1), dt.time())))
    return events.select(
        "event_id", "ts", "user_id", "event_type", "props",
        F.to_date("ts").alias("event_date"),
        F.expr(HOST).alias("hostname"),
        or_not_set(F.expr(DEVICE)).alias("device_category"),
        or_not_set(F.expr(BROWSER)).alias("browser"),
        F.expr(SYSTEM).alias("operating_system"),
        F.expr(EVENT).alias("event_name"),
        (F.col("value") >= 40).alias("engaged"),
        F.round(F.col("value").cast("decimal(16,4)"), 2).cast("decimal(14,2)").alias("engagement_s"),
        (F.col("user_id") * 100000 + F.unix_date(F.to_date("ts"))).alias("session_id"),
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user -> country, region, city."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    ).select(
        F.col("c_custkey").alias("user_id"),
        F.col("r_name").alias("country"),
        or_not_set(F.expr(REGION)).alias("region"),
        or_not_set(F.expr(CITY.replace("user_id", "c_custkey"))).alias("city"),
    )


def user_days(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    """One row per day, user, device and event, with geography."""
    events = raw_events(spark, sf_dir, span)
    reduced = events.groupBy(
        "event_date", "user_id", "hostname", "device_category", "browser", "operating_system", "event_name"
    ).agg(
        F.count("*").alias("sessions"),
        F.count_if("engaged").alias("engaged_sessions"),
        F.sum("engagement_s").alias("user_engagement_seconds"),
    )
    return reduced.join(geography(spark, sf_dir), "user_id")


def _feed(facts: DataFrame, grain: list[str]) -> DataFrame:
    """Feed metrics; the input holds each user once per grain, so counting rows counts users."""
    return facts.groupBy(*grain).agg(
        F.sum("sessions").alias("event_count"),
        F.sum("sessions").alias("sessions"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
        F.count("*").alias("active_users"),
        F.sum("user_engagement_seconds").alias("user_engagement_seconds"),
    )


def _finish(df: DataFrame, name: str) -> DataFrame:
    """Site label, extraction time and published column order."""
    extracted = (F.col("event_date").cast("timestamp_ntz") + F.expr("INTERVAL '1 15' DAY TO HOUR"))
    rows = df.withColumn("site", site_of(F.col("hostname"), SETTINGS)).withColumn("data_extracao", extracted)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER[name]])


def site_feed(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    facts = _feed(user_days(spark, sf_dir, span), [*FEED_GRAIN, "browser", "operating_system", "event_name"])
    return _finish(flag_by_window(facts, SETTINGS), "ga4_eventos")


def panel_feed(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    events = raw_events(spark, sf_dir, span).where(F.col("event_name").isin("painel_acessado", "painel_clicado"))
    reduced = events.groupBy(
        "event_date", "user_id", "hostname", "device_category", "event_name",
        or_not_set(F.expr(PANEL_NAME)).alias("nome_painel_raw"),
    ).agg(
        F.count("*").alias("sessions"),
        F.count_if("engaged").alias("engaged_sessions"),
        F.sum("engagement_s").alias("user_engagement_seconds"),
    ).join(geography(spark, sf_dir), "user_id")
    return _finish(_feed(reduced, [*FEED_GRAIN, "event_name", "nome_painel_raw"]), "ga4_paineis")


def user_feed(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    rolled = rolling_active_users(
        user_days(spark, sf_dir, span.reaching_back(LOOKBACK)),
        ["hostname", "country", "device_category"],
        sums=("sessions", "engaged_sessions", "user_engagement_seconds"),
        until=span.end or last_day(spark, sf_dir), start=span.start,
    )
    zero = F.lit(0)
    return _finish(
        rolled.select(
            "event_date", "hostname", "country", "device_category",
            F.col("users_1d").alias("dau"), F.col("users_7d").alias("wau"), F.col("users_28d").alias("mau"),
            *[F.coalesce(c, zero).alias(c) for c in ("sessions", "engaged_sessions", "user_engagement_seconds")],
        ),
        "ga4_usuarios",
    )


def page_events(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    """Panel page views of the panel site, with the URL that was opened."""
    views = raw_events(spark, sf_dir, span).where(
        (F.col("hostname") == "data.example.org") & (F.col("event_name") == "page_view")
    )
    return views.withColumn("b64", F.base64(F.col("props").cast("binary"))).withColumn("page_location", F.expr(PAGE))


def page_feed(spark: SparkSession, sf_dir: str, span: Span = ALL) -> DataFrame:
    opened = page_events(spark, sf_dir, span.reaching_back(LOOKBACK)).where(F.col("page_location").contains("redirect=")).select(
        "event_date", "hostname", "page_location", "user_id", F.lit(1).cast("bigint").alias("page_views")
    )
    rolled = rolling_active_users(
        opened, ["hostname", "page_location"], sums=("page_views",), until=span.end or last_day(spark, sf_dir),
        start=span.start,
    ).select(
        "event_date", "hostname", "page_location",
        F.coalesce("page_views", F.lit(0)).alias("page_views"),
        F.col("users_1d").alias("usuarios"), F.col("users_7d").alias("usuarios_7d"),
        F.col("users_28d").alias("usuarios_28d"),
    )
    return _finish(rolled.withColumn("alvo", redirect_target(F.col("page_location"))), "ga4_paginas")


def panel_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.min("p_size").alias("ordem_menu"), F.min("p_type").alias("tema"), F.max("p_type").alias("hierarquia")
    )
    rows = brands.select(
        F.col("p_brand").alias("painel"), "ordem_menu", "tema", "hierarquia",
        F.lit(None).cast("string").alias("publico_principal"),
        F.when(F.col("p_brand") == "Brand#25", F.lit("auxiliar")).otherwise(F.lit("painel")).alias("tipo"),
        F.expr(f"{BRAND_NO} % 9 <> 0").alias("ativo"),
    )
    return rows.select(*DIMENSIONS["dim_painel"].names)


def alias_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct().withColumn("n", F.expr(BRAND_NO))
    return brands.where("n IN (1, 2, 9)").select(
        F.concat(F.lit("Brand#"), F.when(F.col("n") == 9, 28).otherwise(F.col("n") + 25).cast("string")).alias("alias"),
        F.col("p_brand").alias("painel"),
    )


def report_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes as report ids of a panel, and one plain page."""
    ids = F.explode(F.array(F.col("p_size").cast("string"), F.lit("tutorial.php"))).alias("alvo")
    targets = table(spark, sf_dir, "part").select(ids).distinct().withColumn("n", F.expr("try_cast(alvo AS INT)"))
    return targets.select(
        "alvo",
        F.concat(F.lit("Brand#"), F.coalesce(F.col("n") % 25 + 1, F.lit(25)).cast("string")).alias("painel"),
        F.expr("CASE n % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'unica' END").alias("versao"),
        F.expr("CASE WHEN n IS NULL THEN 'site' WHEN n % 4 = 0 THEN 'inferido' ELSE 'gtm' END").alias("fonte"),
    )


def region_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kind = F.when(F.col("n_nationkey") % 6 == 5, "Province of ").otherwise("State of ")  # no event has a province
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(kind, F.col("n_name")).alias("region_ga4"),
        F.col("n_name").alias("estado"),
        F.concat(F.lit("U"), F.col("n_nationkey").cast("string")).alias("uf"),
        F.col("r_name").alias("pais"),
    )


class GivenTables:
    """The bundle the views read, each table built only when a view asks for it."""

    settings = SETTINGS

    def __init__(self, spark: SparkSession, sf_dir: str, span: Span = ALL) -> None:
        self._at = (spark, sf_dir)
        self._span = span

    @cached_property
    def ga4_eventos(self) -> DataFrame:
        return site_feed(*self._at, self._span)

    @cached_property
    def ga4_paineis(self) -> DataFrame:
        return panel_feed(*self._at, self._span)

    @cached_property
    def ga4_usuarios(self) -> DataFrame:
        return user_feed(*self._at, self._span)

    @cached_property
    def ga4_paginas(self) -> DataFrame:
        return page_feed(*self._at, self._span)

    @cached_property
    def dim_painel(self) -> DataFrame:
        return panel_dimension(*self._at)

    @cached_property
    def dim_painel_alias(self) -> DataFrame:
        return alias_dimension(*self._at)

    @cached_property
    def dim_painel_relatorio(self) -> DataFrame:
        return report_dimension(*self._at)


def silver(spark: SparkSession, sf_dir: str, span: Span = ALL) -> GivenTables:
    """The given tables as facts of the span's days; nothing before it and its windows is read."""
    return GivenTables(spark, sf_dir, span)
