"""Quality checks over the given tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import constraints, panels
from ..operators.ranking import against_top, numbered_at_scale
from ..plans import load, quality
from ..schemas import CONSTRAINTS, Constraints
from . import dataset as d
from .oracle import big
from .registry import registered

SUNDAY = dt.date(2024, 1, 28)
NOW = dt.datetime(2024, 1, 31, 10, 0)


@registered("quality_completeness", """WITH late AS (
      SELECT 'ga4_eventos' AS tabela, max(event_date) AS last_day FROM eventos UNION ALL SELECT 'ga4_usuarios', max(event_date) FROM usuarios),
    weeks AS (SELECT DATE '2024-01-28' AS sunday UNION ALL SELECT DATE '2024-02-04')
    SELECT sunday, tabela, last_day, CAST(NULL AS TIMESTAMP) AS extracted_at, 'missing_days' AS problem
    FROM late, weeks WHERE last_day < sunday""")
def quality_completeness(spark, sf_dir):
    """The closed week passes (no rows); the week still running is reported for both tables."""
    silver = d.silver(spark, sf_dir)
    weeks = (SUNDAY, SUNDAY + dt.timedelta(days=7))
    parts = [quality.week_completeness(silver, w).withColumn("sunday", F.lit(w)) for w in weeks]
    return reduce(DataFrame.unionByName, parts)


@registered("quality_completeness_early", """SELECT tabela, last_day, TIMESTAMP '2024-01-29 15:00:00' AS extracted_at, 'extracted_early' AS problem FROM (
      SELECT 'ga4_eventos' AS tabela, max(event_date) AS last_day FROM eventos UNION ALL SELECT 'ga4_usuarios', max(event_date) FROM usuarios)""")
def quality_completeness_early(spark, sf_dir):
    """Where a day is final at four in the afternoon, the Sunday that was extracted at three is not."""
    silver = d.silver(spark, sf_dir)
    silver.settings = replace(d.SETTINGS, day_closes_at_hour=16)
    return quality.week_completeness(silver, SUNDAY)


@registered("quality_freshness", """SELECT last_minute, date_diff('minute', last_minute, TIMESTAMP '2024-01-31 10:00:00') / 60 AS lag_hours,
    last_minute >= TIMESTAMP '2024-01-31' AS yesterday_closed,
    CASE WHEN last_minute < TIMESTAMP '2024-01-31' THEN date_diff('minute', last_minute, TIMESTAMP '2024-01-31') / 60 END AS hours_missing
    FROM (SELECT date_trunc('minute', max(ts)) AS last_minute FROM events)""")
def quality_freshness(spark, sf_dir):
    return quality.freshness(d.raw_events(spark, sf_dir), NOW)


@registered("quality_daily_totals", """SELECT event_date, count(*) AS "eventCount", count(DISTINCT (user_id, event_date)) AS "sessions",
    count(DISTINCT user_id) AS "activeUsers", CAST(CAST(sum(cents) AS BIGINT) AS DOUBLE) / 100 AS "userEngagementDuration"
    FROM raw_events WHERE event_date BETWEEN DATE '2024-01-25' AND DATE '2024-01-31' GROUP BY ALL""")
def quality_daily_totals(spark, sf_dir):
    from ..operators.reports import ReportSpec, run_report

    spec = ReportSpec(
        ("event_date",), ("eventCount", "sessions", "activeUsers", "userEngagementDuration"),
        start="6daysAgo", end="today", order_by=(("event_date", False),),
    )
    return run_report(d.raw_events(spark, sf_dir), spec, NOW.date())


@registered("quality_tag_hours", """SELECT date_trunc('hour', ts) AS "hour", event_name, count(*) AS "eventCount" FROM raw_events
    WHERE event_name IN ('painel_acessado', 'painel_clicado') AND event_date >= DATE '2024-01-29' GROUP BY ALL""")
def quality_tag_hours(spark, sf_dir):
    from ..operators.reports import ReportSpec, in_list, run_report, time_grain

    spec = ReportSpec(
        (time_grain("hour"), "event_name"), ("eventCount",), start="2daysAgo", end="today",
        where=in_list("event_name", ["painel_acessado", "painel_clicado"]), order_by=(("hour", False), ("event_name", False)),
    )
    return run_report(d.raw_events(spark, sf_dir), spec, NOW.date())


@registered("quality_silver_counts", """SELECT 'ga4_eventos' AS tabela, count(*) AS linhas, count(*) FILTER (WHERE trafego_valido) AS validas, count(DISTINCT event_date) AS dias FROM eventos
    UNION ALL SELECT 'ga4_paineis', count(*), NULL, count(DISTINCT event_date) FROM paineis
    UNION ALL SELECT 'ga4_usuarios', count(*), NULL, count(DISTINCT event_date) FROM usuarios
    UNION ALL SELECT 'ga4_paginas', count(*), NULL, count(DISTINCT event_date) FROM paginas""")
def quality_silver_counts(spark, sf_dir):
    return load.silver_counts(d.silver(spark, sf_dir))


@registered("quality_gold_counts", " UNION ALL ".join(
    f"SELECT '{v}' AS visao, count(*) AS linhas FROM {v}" for v in (
        "vw_paineis_ranking", "vw_site_overview", "vw_paineis_sem_mapeamento", "vw_usuarios_ativos",
        "vw_paineis_acessos", "vw_paineis_url_sem_mapa")))
def quality_gold_counts(spark, sf_dir):
    return load.gold_counts(d.silver(spark, sf_dir))


@registered("quality_dim_counts", """SELECT 'dim_painel' AS tabela, tipo AS grupo, count(*) AS linhas FROM dim_painel WHERE ativo GROUP BY tipo
    UNION ALL SELECT 'dim_painel_alias', '', count(*) FROM dim_alias
    UNION ALL SELECT 'dim_painel_relatorio', fonte, count(*) FROM dim_relatorio GROUP BY fonte""")
def quality_dim_counts(spark, sf_dir):
    return load.dimension_counts(d.silver(spark, sf_dir))


def _robots(dims: str) -> str:
    order = ", ".join(dims.split(", "))
    return f"""SELECT {dims}, sessions, engaged_sessions, events, CAST(engaged_sessions AS DOUBLE) / sessions AS engagement_rate,
        (CAST(cents AS DOUBLE) / 100) / sessions AS mean_seconds
      FROM (SELECT {dims}, {big("sum(sessions)")} AS sessions, {big("sum(engaged_sessions)")} AS engaged_sessions,
              {big("sum(event_count)")} AS events, {big("sum(cents)")} AS cents FROM eventos GROUP BY ALL)
      ORDER BY sessions DESC, {order} LIMIT 50"""


@registered("quality_robots_country", _robots("country"))
def quality_robots_country(spark, sf_dir):
    return quality.robots_by(d.site_feed(spark, sf_dir), ["country"])


@registered("quality_robots_host_country_browser", _robots("hostname, country, browser"))
def quality_robots_host_country_browser(spark, sf_dir):
    return quality.robots_by(d.site_feed(spark, sf_dir), ["hostname", "country", "browser"])


@registered("quality_inflation", """WITH u AS (SELECT DISTINCT hostname, device_category, browser, user_id, event_date FROM raw_events),
      n AS (SELECT unnest([1, 7, 28]) AS days),
      exact AS (SELECT hostname, days, count(DISTINCT user_id) AS exact FROM u JOIN n ON event_date > DATE '2024-01-28' - CAST(days AS INT) AND event_date <= DATE '2024-01-28' GROUP BY ALL),
      fine AS (SELECT hostname, days, device_category, browser, count(DISTINCT user_id) AS c FROM u JOIN n ON event_date > DATE '2024-01-28' - CAST(days AS INT) AND event_date <= DATE '2024-01-28' GROUP BY ALL)
    SELECT hostname, days || 'd' AS janela, exact, CAST(sum(c) AS BIGINT) AS summed, CAST(CAST(sum(c) AS BIGINT) AS DOUBLE) / exact - 1 AS inflation
    FROM exact JOIN fine USING (hostname, days) GROUP BY hostname, days, exact""")
def quality_inflation(spark, sf_dir):
    events = d.raw_events(spark, sf_dir)
    return quality.user_inflation(events, ["hostname"], ["hostname", "device_category", "browser"], SUNDAY)


@registered("quality_map_coverage", f"""SELECT CASE WHEN alvo IS NULL THEN 'unreadable'
      WHEN alvo IN (SELECT alvo FROM dim_relatorio) THEN 'mapped' ELSE 'unmapped' END AS estado, {big("sum(page_views)")} AS page_views
    FROM paginas WHERE site = 'Dados' GROUP BY 1""")
def quality_map_coverage(spark, sf_dir):
    return quality.map_coverage(d.silver(spark, sf_dir))


@registered("quality_history_depth", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, count(*) AS events,
    count(DISTINCT o_custkey) AS users FROM orders GROUP BY ALL""")
def quality_history_depth(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("event_date"), "o_orderstatus", F.col("o_custkey").alias("user_id")
    )
    return quality.history_depth(orders, ["o_orderstatus"])


_CUSTOM = Constraints(
    not_null=("o_orderkey", "o_custkey"), unique=(("o_orderkey",), ("o_custkey",)),
    max_length=(("o_orderpriority", 6), ("o_orderstatus", 1)), references=(("o_custkey", "customer", "c_custkey"),),
)


@registered("quality_constraints", """SELECT 'orders' AS tabela, 'not_null' AS rule, 'o_orderkey' AS target, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'orders', 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'orders', 'max_length', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 6) FROM orders
    UNION ALL SELECT 'orders', 'max_length', 'o_orderstatus', count(*) FILTER (WHERE length(o_orderstatus) > 1) FROM orders
    UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'orders', 'unique', 'o_custkey', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'orders', 'references', 'o_custkey->customer.c_custkey', count(*) FROM orders ANTI JOIN (SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey FROM customer) ON c_custkey = o_custkey""")
def quality_constraints(spark, sf_dir):
    """All kinds of rules, with real violations: a repeated key, long text, and orphans of parents whose key has changed."""
    changed = F.expr("CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END")
    parent = d.table(spark, sf_dir, "customer").withColumn("c_custkey", changed)
    return constraints.check_table("orders", d.table(spark, sf_dir, "orders"), _CUSTOM, {"customer": parent})


@registered("quality_dim_constraints", """SELECT tabela, CAST(sum(v) AS BIGINT) AS violations FROM (
      SELECT 'dim_painel' AS tabela, count(*) FILTER (WHERE painel IS NULL OR tipo IS NULL OR ativo IS NULL) AS v FROM dim_painel
      UNION ALL SELECT 'dim_painel', count(*) FROM (SELECT painel FROM dim_painel GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'dim_painel_relatorio', count(*) FROM dim_relatorio ANTI JOIN dim_painel USING (painel)
      UNION ALL SELECT 'dim_painel_alias', count(*) FROM dim_alias ANTI JOIN dim_painel USING (painel)) GROUP BY ALL""")
def quality_dim_constraints(spark, sf_dir):
    silver = d.silver(spark, sf_dir)
    tables = {n: getattr(silver, n) for n in ("dim_painel", "dim_painel_relatorio", "dim_painel_alias")}
    checks = [constraints.check_table(n, df, CONSTRAINTS[n], tables) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, checks).groupBy("tabela").agg(F.sum("violations").alias("violations"))


@registered("quality_grain", """SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def quality_grain(spark, sf_dir):
    return constraints.repeated_grain(d.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


_OPENED_ON = "CASE WHEN user_id % (2 + event_id % 30 % 9) = 0 THEN 'tablet' ELSE device_category END"


@registered("quality_version_label", f"""WITH per AS (SELECT nome_painel_raw AS target, {_OPENED_ON} AS device_category, count(*) AS n FROM raw_events GROUP BY ALL),
      best AS (SELECT *, sum(n) OVER (PARTITION BY target) AS total, row_number() OVER (PARTITION BY target ORDER BY n DESC, device_category) AS rn FROM per)
    SELECT target, CAST(total AS BIGINT) AS total, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS share,
      CASE WHEN n / total >= 0.8 THEN device_category ELSE 'unica' END AS versao FROM best WHERE rn = 1""")
def quality_version_label(spark, sf_dir):
    """Targets of which from a half to a tenth of the opens is on a second device."""
    opens = d.raw_events(spark, sf_dir).withColumns({
        "target": d.or_not_set(F.expr(d.PANEL_NAME)), "device_category": F.expr(_OPENED_ON), "n": F.lit(1).cast("bigint")})
    return quality.version_by_device(opens, "target", "device_category", "n")


@registered("quality_listing", """SELECT nome_painel_raw, count(*) AS n FROM raw_events WHERE event_name = 'painel_acessado'
    GROUP BY ALL""")
def quality_listing(spark, sf_dir):
    rows = d.raw_events(spark, sf_dir).where(F.col("event_name") == "painel_acessado")
    return quality.listing(rows.select(d.or_not_set(F.expr(d.PANEL_NAME)).alias("nome_painel_raw")), ["nome_painel_raw"])


_BOOKED = "CAST(o_orderdate AS DATE) - CAST(day(o_orderdate) % 3 AS INT)"


@registered("order_positions", """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position,
      CAST(greatest(2, round_even(100 * (o_totalprice / (SELECT max(o_totalprice) FROM orders)), 0)) AS INT) AS width_pct FROM orders""")
def order_positions(spark, sf_dir):
    """Every order's place by price and its bar against the dearest one; no task sees the whole table."""
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return against_top(numbered_at_scale(orders, F.desc("o_totalprice"), F.asc("o_orderkey")), "o_totalprice")


@registered("quality_missing_days", f"""WITH busy AS (SELECT DISTINCT {_BOOKED} AS event_date FROM orders)
    SELECT event_date FROM (SELECT CAST(unnest(generate_series((SELECT min(event_date) FROM busy), (SELECT max(event_date) FROM busy), INTERVAL 1 DAY)) AS DATE) AS event_date)
    ANTI JOIN busy USING (event_date)""")
def quality_missing_days(spark, sf_dir):
    """Days without a booking, where orders are booked every third day of the month."""
    day = F.date_sub(F.to_date("o_orderdate"), F.day("o_orderdate") % 3)
    busy = d.table(spark, sf_dir, "orders").select(day.alias("event_date"))
    first, last = busy.agg(F.min("event_date")).scalar(), busy.agg(F.max("event_date")).scalar()
    return quality.missing_days(busy, first, last)


@registered("quality_hourly_gaps", """WITH h AS (SELECT DISTINCT hostname, date_trunc('hour', ts) AS hour FROM raw_events WHERE event_name = 'page_view'),
      p AS (SELECT *, lag(hour) OVER (PARTITION BY hostname ORDER BY hour) AS previous FROM h)
    SELECT hostname, hour, previous, CAST(date_diff('hour', previous, hour) - 1 AS BIGINT) AS empty_hours FROM p
    WHERE date_diff('hour', previous, hour) - 1 >= 2""")
def quality_hourly_gaps(spark, sf_dir):
    views = d.raw_events(spark, sf_dir).where(F.col("event_name") == "page_view")
    return quality.hourly_gaps(views, "hostname", 2)


@registered("quality_signal_ratio", f"""WITH o AS (SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, {big("sum(page_views)")} AS opens
      FROM paginas WHERE site = 'Dados' AND alvo IN (SELECT alvo FROM dim_relatorio JOIN dim_painel USING (painel) WHERE ativo) GROUP BY ALL),
      c AS (SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, {big("sum(event_count)")} AS clicks FROM paineis
            WHERE site = 'Dados' AND event_name = 'painel_acessado' GROUP BY ALL),
      r AS (SELECT week, COALESCE(opens, 0) AS opens, COALESCE(clicks, 0) AS clicks,
              COALESCE(CAST(COALESCE(clicks, 0) AS DOUBLE) / NULLIF(COALESCE(opens, 0), 0), 0.0) AS ratio FROM o FULL JOIN c USING (week))
    SELECT week, opens, clicks, ratio, COALESCE(ratio < lag(ratio) OVER (ORDER BY week) * 0.75, false) AS broken FROM r""")
def quality_signal_ratio(spark, sf_dir):
    return quality.click_signal(d.silver(spark, sf_dir), "painel_acessado", max_drop=0.25)


@registered("key_sets", """SELECT k, bool_or(a) AS in_dimension, bool_or(b) AS in_facts FROM (
      SELECT painel AS k, true AS a, false AS b FROM dim_painel UNION ALL SELECT DISTINCT nome_painel_raw, false, true FROM paineis) GROUP BY k""")
def key_sets(spark, sf_dir):
    """Union of the names known and the names seen, and on which side each is."""
    yes, no = F.lit(True), F.lit(False)
    known = d.panel_dimension(spark, sf_dir).select(F.col("painel").alias("k"), yes.alias("a"), no.alias("b"))
    seen = d.panel_feed(spark, sf_dir).select(F.col("nome_painel_raw").alias("k"), no.alias("a"), yes.alias("b"))
    return known.union(seen).groupBy("k").agg(F.bool_or("a").alias("in_dimension"), F.bool_or("b").alias("in_facts"))


@registered("target_sets", """SELECT DISTINCT alvo, alvo IN (SELECT alvo FROM dim_relatorio) AS mapped FROM page_targets WHERE alvo IS NOT NULL""")
def target_sets(spark, sf_dir):
    """Opened targets inside and outside the map."""
    pages = d.page_feed(spark, sf_dir).where("alvo is not null")
    marked = panels.mark_targets(pages, d.report_dimension(spark, sf_dir))
    return marked.select("alvo", F.col("mapeado").alias("mapped")).distinct()


@registered("expected_columns", """SELECT 'events' AS tabela, count(*) AS linhas,
      (SELECT string_agg(c, ',' ORDER BY c) FROM (VALUES ('event_id'), ('ts'), ('user_id'), ('session_id')) AS v(c)
       WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM events))) AS missing FROM events""")
def expected_columns(spark, sf_dir):
    """Columns that the file itself has, whatever schema is declared for it."""
    missing = constraints.missing_in_file(spark, f"{sf_dir}/events.parquet", ["event_id", "ts", "user_id", "session_id"])
    return d.table(spark, sf_dir, "events").agg(
        F.lit("events").alias("tabela"), F.count("*").alias("linhas"), F.lit(",".join(missing)).alias("missing"))
