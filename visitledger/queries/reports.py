"""Dimensions x metrics reports, rolling users and event matching over the raw events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reports as r
from ..operators.matching import dominant_label, last_label_before, reconcile
from ..operators.rolling import (
    daily_user_sketches, rolling_active_users, rolling_active_users_sketch, rolling_from_sketches,
)
from ..session import shared_dir
from ..sources.tables import Warehouse
from . import dataset as d
from .oracle import SITE, money
from .registry import registered

SUNDAY = dt.date(2024, 1, 28)
TODAY = dt.date(2024, 1, 31)

_METRICS = f"""count(*) AS "eventCount", count(DISTINCT (user_id, event_date)) AS "sessions",
    count(DISTINCT (user_id, event_date)) FILTER (WHERE engaged) AS "engagedSessions",
    count(DISTINCT user_id) AS "activeUsers", {money('CAST(sum(cents) AS BIGINT)', '"userEngagementDuration"')}"""
_ALL = ("eventCount", "sessions", "engagedSessions", "activeUsers", "userEngagementDuration")


@registered("report_site", f"""SELECT event_date, hostname, device_category, browser, event_name, {_METRICS}
    FROM raw_events GROUP BY ALL""")
def report_site(spark, sf_dir):
    spec = r.ReportSpec(("event_date", "hostname", "device_category", "browser", "event_name"), _ALL)
    return r.run_report(d.raw_events(spark, sf_dir), spec)


@registered("report_period", f"""SELECT hostname, device_category, {_METRICS} FROM raw_events
    WHERE event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' GROUP BY ALL""")
def report_period(spark, sf_dir):
    """Without a date dimension sessions and users are distinct over the whole range."""
    spec = r.ReportSpec(("hostname", "device_category"), _ALL, start="2024-01-22", end="2024-01-28")
    return r.run_report(d.raw_events(spark, sf_dir), spec)


@registered("report_panel_events", f"""SELECT event_date, event_name, nome_painel_raw, {_METRICS} FROM raw_events
    WHERE event_name IN ('painel_acessado', 'painel_clicado') GROUP BY ALL""")
def report_panel_events(spark, sf_dir):
    """In-list filter."""
    events = d.raw_events(spark, sf_dir).withColumn("nome_painel_raw", d.or_not_set(F.expr(d.PANEL_NAME)))
    spec = r.ReportSpec(
        ("event_date", "event_name", "nome_painel_raw"), _ALL,
        where=r.in_list("event_name", ["painel_acessado", "painel_clicado"]),
    )
    return r.run_report(events, spec)


@registered("report_page_opens", """SELECT event_date, page_location, count(*) AS "eventCount",
    count(DISTINCT user_id) AS "activeUsers" FROM page_hits GROUP BY ALL""")
def report_page_opens(spark, sf_dir):
    """Exact filters and a contains filter in one AND group."""
    events = d.raw_events(spark, sf_dir).withColumn("b64", F.base64(F.col("props").cast("binary"))).withColumn(
        "page_location", F.expr(d.PAGE)
    )
    spec = r.ReportSpec(
        ("event_date", "page_location"), ("eventCount", "activeUsers"),
        where=r.all_of(
            r.exact("hostname", "data.example.org"), r.exact("event_name", "page_view"),
            r.contains("page_location", "redirect="),
        ),
    )
    return r.run_report(events, spec)


@registered("report_ordered_page", """SELECT hostname, event_name, browser, count(*) AS "eventCount" FROM raw_events
    GROUP BY ALL ORDER BY count(*) DESC, hostname, event_name, browser LIMIT 20 OFFSET 10""")
def report_ordered_page(spark, sf_dir):
    spec = r.ReportSpec(
        ("hostname", "event_name", "browser"), ("eventCount",), limit=20, offset=10,
        order_by=(("eventCount", True), ("hostname", False), ("event_name", False), ("browser", False)),
    )
    return r.run_report(d.raw_events(spark, sf_dir), spec)


@registered("report_nonempty", """SELECT event_date, hostname, event_name, device_category,
    count(DISTINCT (user_id, event_date)) FILTER (WHERE engaged) AS "engagedSessions" FROM raw_events GROUP BY ALL
    HAVING count(*) FILTER (WHERE engaged) > 0""")
def report_nonempty(spark, sf_dir):
    """Rows whose metrics are all zero are left out."""
    spec = r.ReportSpec(("event_date", "hostname", "event_name", "device_category"), ("engagedSessions",))
    return r.run_report(d.raw_events(spark, sf_dir), spec)


@registered("report_relative_days", """SELECT event_date, count(*) AS "eventCount", count(DISTINCT user_id) AS "activeUsers"
    FROM raw_events WHERE event_date BETWEEN DATE '2024-01-25' AND DATE '2024-01-30' GROUP BY ALL""")
def report_relative_days(spark, sf_dir):
    spec = r.ReportSpec(("event_date",), ("eventCount", "activeUsers"), start="6daysAgo", end="yesterday")
    return r.run_report(d.raw_events(spark, sf_dir), spec, TODAY)


@registered("report_time_grains", """
    SELECT 'minute' AS grain, date_trunc('minute', ts) AS at, count(*) AS events FROM events GROUP BY ALL
    UNION ALL SELECT 'hour', date_trunc('hour', ts), count(*) FROM events GROUP BY ALL
    UNION ALL SELECT 'day', CAST(date_trunc('day', ts) AS TIMESTAMP), count(*) FROM events GROUP BY ALL
    UNION ALL SELECT 'month', CAST(date_trunc('month', ts) AS TIMESTAMP), count(*) FROM events GROUP BY ALL""")
def report_time_grains(spark, sf_dir):
    """Minute counts are made once; the coarser grains add them up."""
    events = d.raw_events(spark, sf_dir)
    minutes = events.groupBy(r.time_grain("minute")).agg(F.count("*").alias("events"))
    grains = F.inline(F.array(*[
        F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "minute").cast("timestamp_ntz").alias("at"))
        for g in ("minute", "hour", "day", "month")
    ]))
    return minutes.select("events", grains).groupBy("grain", "at").agg(F.sum("events").alias("events"))


@registered("report_engagement_rate", """SELECT browser, device_category,
    CAST(count(DISTINCT (user_id, event_date)) FILTER (WHERE engaged) AS DOUBLE) / count(DISTINCT (user_id, event_date))
      AS "engagementRate" FROM raw_events GROUP BY ALL""")
def report_engagement_rate(spark, sf_dir):
    spec = r.ReportSpec(("browser", "device_category"), ("engagementRate",), keep_empty_rows=True)
    return r.run_report(d.raw_events(spark, sf_dir), spec)


@registered("period_users", """SELECT hostname, device_category, count(DISTINCT user_id) AS users FROM raw_events
    WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY ALL""")
def period_users(spark, sf_dir):
    return r.period_users(
        d.raw_events(spark, sf_dir), ["hostname", "device_category"], dt.date(2024, 1, 8), dt.date(2024, 1, 21)
    )


def _rolling_sql(keys: str) -> str:
    comma = f"{keys}, " if keys else ""
    return f"""WITH seen AS (SELECT DISTINCT {comma}user_id, event_date AS day FROM raw_events),
      days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM seen), (SELECT max(day) FROM seen), INTERVAL 1 DAY)) AS DATE) AS event_date)
    SELECT {comma}event_date, count(DISTINCT user_id) FILTER (WHERE day = event_date) AS users_1d,
           count(DISTINCT user_id) FILTER (WHERE day > event_date - 7) AS users_7d, count(DISTINCT user_id) AS users_28d
    FROM days JOIN seen ON day BETWEEN event_date - 27 AND event_date GROUP BY ALL"""


@registered("rolling_users_1_7_28", _rolling_sql("hostname, device_category"))
def rolling_users(spark, sf_dir):
    return rolling_active_users(
        d.raw_events(spark, sf_dir), ["hostname", "device_category"], until=d.last_day(spark, sf_dir)
    )


@registered("rolling_users_total", _rolling_sql(""))
def rolling_users_total(spark, sf_dir):
    return rolling_active_users(d.raw_events(spark, sf_dir), [], until=d.last_day(spark, sf_dir))


@registered("rolling_users_sketch")
def rolling_users_sketch(spark, sf_dir):
    """Estimates: no statement can give the same numbers; tests hold them against the exact counts."""
    return rolling_active_users_sketch(d.raw_events(spark, sf_dir), ["hostname"], until=d.last_day(spark, sf_dir))


_SKETCH_BOUND = 0.05


@registered("rolling_users_sketch_error", f"""SELECT hostname, event_date, users_7d, users_28d, true AS within FROM ({_rolling_sql("hostname")})""")
def rolling_users_sketch_error(spark, sf_dir):
    """Exact users beside estimates from stored daily sketches, and whether these are within three standard errors.

    The sketches of the first half of the month and of the rest are stored in two runs, as daily loads would.
    """
    wh, last = Warehouse(spark, shared_dir(spark, "sketches")), d.last_day(spark, sf_dir)
    middle = dt.date(2024, 1, 15)
    for span in (d.Span(None, middle), d.Span(middle + dt.timedelta(days=1), None)):
        wh.store_sketches("site_users", daily_user_sketches(d.raw_events(spark, sf_dir, span), ["hostname"]))
    stored = wh.sketches("site_users", T.StructType([T.StructField("hostname", T.StringType())]))
    about = rolling_from_sketches(stored, ["hostname"], until=last).withColumnsRenamed({"users_7d": "about_7d", "users_28d": "about_28d"})
    exact = rolling_active_users(d.raw_events(spark, sf_dir), ["hostname"], until=last)
    near = lambda n: F.abs(F.col(f"about_{n}") - F.col(f"users_{n}")) <= F.greatest(
        F.lit(1.0), _SKETCH_BOUND * F.col(f"users_{n}"))
    both = exact.join(about, ["hostname", "event_date"], "left")
    return both.select("hostname", "event_date", "users_7d", "users_28d", F.coalesce(near("7d") & near("28d"), F.lit(False)).alias("within"))


@registered("closed_week_users", """SELECT hostname, count(DISTINCT user_id) AS closed_week,
    count(DISTINCT user_id) AS rolling_7d FROM raw_events
    WHERE event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' GROUP BY ALL""")
def closed_week_users(spark, sf_dir):
    """The 7-day count on a Sunday equals the distinct users of the closed week."""
    events = d.raw_events(spark, sf_dir, d.Span(SUNDAY, SUNDAY).reaching_back(d.LOOKBACK))
    closed = r.period_users(events, ["hostname"], SUNDAY - dt.timedelta(days=6), SUNDAY)
    rolled = rolling_active_users(events, ["hostname"], start=SUNDAY, until=SUNDAY)
    return closed.join(rolled, "hostname").select(
        "hostname", F.col("users").alias("closed_week"), F.col("users_7d").alias("rolling_7d")
    )


_MATCH = """SELECT v.event_id, v.user_id, arg_max(c.event_type_k, (c.ts, c.event_id)) AS label, v.hostname AS target
    FROM raw_events v JOIN (SELECT event_id, ts, user_id, nome_painel_raw AS event_type_k FROM raw_events
         WHERE event_type = 'click') c
      ON c.user_id = v.user_id AND c.ts < v.ts AND c.ts >= v.ts - INTERVAL 1 HOUR
    WHERE v.event_type = 'view' GROUP BY v.event_id, v.user_id, v.hostname"""


def _matches(spark, sf_dir):
    events = d.raw_events(spark, sf_dir).withColumn("panel", d.or_not_set(F.expr(d.PANEL_NAME)))
    return last_label_before(
        events, "user_id", "ts", "event_id",
        is_label=F.col("event_type") == "click", is_target=F.col("event_type") == "view",
        label=F.col("panel"), target=F.col("hostname"), seconds=3600,
    )


@registered("label_previous_event", _MATCH)
def label_previous_event(spark, sf_dir):
    """The panel click just before a page view, by the same user within an hour."""
    return _matches(spark, sf_dir)


@registered("label_dominant", f"""WITH m AS ({_MATCH}), c AS (SELECT target, label, count(*) AS n FROM m GROUP BY ALL)
    SELECT target, label, n, CAST(total AS BIGINT) AS matches FROM (SELECT *, sum(n) OVER (PARTITION BY target) AS total,
      row_number() OVER (PARTITION BY target ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1""")
def label_dominant(spark, sf_dir):
    return dominant_label(_matches(spark, sf_dir))


@registered("reconcile_daily", """WITH a AS (SELECT event_date, hostname, event_name, count(*) AS n FROM raw_events GROUP BY ALL),
      b AS (SELECT event_date + CAST(user_id % 11 = 3 AS INT) AS event_date,
              CASE WHEN event_name = 'page_view' AND event_id % 2 = 0 THEN 'localhost' ELSE hostname END AS hostname, event_name, count(*) AS n
            FROM raw_events GROUP BY ALL)
    SELECT event_date, hostname, event_name, COALESCE(a.n, 0) AS left_value, COALESCE(b.n, 0) AS right_value,
      COALESCE(a.n, 0) - COALESCE(b.n, 0) AS difference,
      CAST(COALESCE(a.n, 0) - COALESCE(b.n, 0) AS DOUBLE) / b.n AS relative_difference
    FROM a FULL JOIN b USING (event_date, hostname, event_name)""")
def reconcile_daily(spark, sf_dir):
    """Feed counts against a second source that dates some events a day later and files others under another host."""
    feed = d.raw_events(spark, sf_dir).withColumn("n", F.lit(1).cast("bigint"))
    other = feed.withColumns({
        "event_date": F.expr("date_add(event_date, CAST(user_id % 11 = 3 AS INT))"),
        "hostname": F.expr("CASE WHEN event_name = 'page_view' AND event_id % 2 = 0 THEN 'localhost' ELSE hostname END")})
    return reconcile(feed, other, ["event_date", "hostname", "event_name"], "n")


@registered("host_sites", f"""SELECT hostname, {SITE} AS site, count(*) AS events FROM raw_events GROUP BY ALL""")
def host_sites(spark, sf_dir):
    counts = d.raw_events(spark, sf_dir).groupBy("hostname").agg(F.count("*").alias("events"))
    return counts.select("hostname", d.site_of(F.col("hostname"), d.SETTINGS).alias("site"), "events")
