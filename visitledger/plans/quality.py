"""Completeness, freshness, coverage and reconciliation checks. Each returns rows to look at; none changes data."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WINDOW_DAYS
from ..functions.dates import instant, micros, week_start
from ..functions.text import ratio
from ..operators.matching import signal_ratio
from ..operators.panels import mark_targets, with_target
from .gold import Silver


def loaded_days(s: Silver, tables: tuple[str, ...]) -> DataFrame:
    """(tabela, event_date, linhas, data_extracao) of fact tables: as noted by the loads, or else counted."""
    if getattr(s, "days", None) is not None:
        return s.days.where(F.col("tabela").isin(*tables))
    parts = [getattr(s, name).groupBy("event_date").agg(
        F.count("*").alias("linhas"), F.max("data_extracao").alias("data_extracao")).select(
        F.lit(name).alias("tabela"), "event_date", "linhas", "data_extracao") for name in tables]
    return reduce(DataFrame.unionByName, parts)


def week_completeness(s: Silver, sunday: dt.date, tables: tuple[str, ...] = ("ga4_eventos", "ga4_usuarios")) -> DataFrame:
    """Tables for which the week is not closed: Sunday missing, or extracted before it was final. Empty = pass.

    Where the loads have noted their days, no fact table is read.
    """
    closes = dt.datetime.combine(sunday + dt.timedelta(days=1), dt.time(s.settings.day_closes_at_hour))
    days = loaded_days(s, tables).where("linhas > 0")
    on_sunday = F.when(F.col("event_date") == F.lit(sunday), F.col("data_extracao"))
    found = days.groupBy("tabela").agg(F.max("event_date").alias("last_day"), F.max(on_sunday).alias("extracted_at"))
    names = days.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("tabela"))
    missing = F.col("last_day").isNull() | (F.col("last_day") < F.lit(sunday))
    early = F.col("extracted_at").isNull() | (F.col("extracted_at") < instant(closes))
    problem = F.when(missing, F.lit("missing_days")).when(early, F.lit("extracted_early"))
    return names.join(found, "tabela", "left").withColumn("problem", problem).where("problem is not null")


def freshness(events: DataFrame, now: dt.datetime, ts: str = "ts") -> DataFrame:
    """Latest minute with data, lag in hours, and whether yesterday is closed. ``now`` is in the events' own zone."""
    at = instant(now)
    midnight = instant(dt.datetime.combine(now.date(), dt.time()))
    last = F.date_trunc("minute", F.max(ts)).cast("timestamp_ntz")
    return events.agg(last.alias("last_minute")).select(
        "last_minute",
        ((micros(at) - micros(F.col("last_minute"))) / 3_600_000_000).alias("lag_hours"),
        (F.col("last_minute") >= midnight).alias("yesterday_closed"),
        F.when(
            F.col("last_minute") < midnight, (micros(midnight) - micros(F.col("last_minute"))) / 3_600_000_000
        ).alias("hours_missing"),
    )


def robots_by(events: DataFrame, dims: list[str], limit: int = 50) -> DataFrame:
    """Sessions, engaged sessions, rate and mean seconds by any dimensions, largest first."""
    return events.groupBy(*dims).agg(
        F.sum("sessions").alias("sessions"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
        F.sum("user_engagement_seconds").cast("double").alias("seconds"),
        F.sum("event_count").alias("events"),
    ).select(
        *dims, "sessions", "engaged_sessions", "events",
        ratio(F.col("engaged_sessions"), F.col("sessions")).alias("engagement_rate"),
        ratio(F.col("seconds"), F.col("sessions")).alias("mean_seconds"),
    ).orderBy(F.desc("sessions"), *[F.asc(d) for d in dims]).limit(limit)


def user_inflation(
    activity: DataFrame, coarse: list[str], fine: list[str], day: dt.date, windows: tuple[int, ...] = WINDOW_DAYS
) -> DataFrame:
    """How much summing users of a finer grain overstates the exact count, per window, on one day.

    On a single day a user is inside a window when their last visit is, so the latest visit per user answers all
    windows at once, first per fine member and then per coarse one.
    """
    since = F.lit(day - dt.timedelta(days=max(windows) - 1))
    recent = activity.where(F.col("event_date").between(since, F.lit(day)) & F.col("user_id").isNotNull())
    per_fine = recent.groupBy(*fine, "user_id").agg(F.max("event_date").alias("_last"))

    def inside(n: int) -> Column:
        return F.col("_last") > F.lit(day - dt.timedelta(days=n))

    per_user = per_fine.groupBy(*coarse, "user_id").agg(
        *[F.count_if(inside(n)).alias(f"_rows_{n}") for n in windows], F.max("_last").alias("_last")
    )
    totals = per_user.groupBy(*coarse).agg(
        *[F.count_if(inside(n)).alias(f"_exact_{n}") for n in windows],
        *[F.sum(f"_rows_{n}").alias(f"_summed_{n}") for n in windows],
    )
    return totals.select(*coarse, F.inline(F.array(*[
        F.struct(
            F.lit(f"{n}d").alias("janela"), F.col(f"_exact_{n}").alias("exact"), F.col(f"_summed_{n}").alias("summed"),
            (ratio(F.col(f"_summed_{n}"), F.col(f"_exact_{n}")) - 1).alias("inflation"),
        )
        for n in windows
    ])))


def map_coverage(s: Silver) -> DataFrame:
    """Page views by whether the URL could be read and whether its target is mapped."""
    rows = mark_targets(s.ga4_paginas.where(F.col("site") == s.settings.panel_site.label), s.dim_painel_relatorio)
    state = (
        F.when(F.col("mapeado"), F.lit("mapped")).when(F.col("alvo").isNull(), F.lit("unreadable"))
        .otherwise(F.lit("unmapped"))
    )
    return rows.groupBy(state.alias("estado")).agg(F.sum("page_views").alias("page_views"))


def history_depth(events: DataFrame, keys: list[str] | None = None, day: str = "event_date") -> DataFrame:
    """Distinct users and events per month: how far back a combination of dimensions reaches."""
    month = F.trunc(day, "MM").alias("month")
    return events.groupBy(month, *(keys or [])).agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


def version_by_device(opens: DataFrame, target: str, device: str, count: str, least: float = 0.8) -> DataFrame:
    """Version of each target: the device with at least 80% of its opens, else ``unica``."""
    per_device = opens.groupBy(target, device).agg(F.sum(count).alias("_n"))
    best = F.min_by(F.struct(device, "_n"), F.struct(-F.col("_n"), F.col(device)))
    whole = per_device.groupBy(target).agg(best.alias("_best"), F.sum("_n").alias("total"))
    share = ratio(F.col("_best._n"), F.col("total"))
    return whole.select(
        target, "total", share.alias("share"),
        F.when(share >= least, F.col(f"_best.{device}")).otherwise(F.lit("unica")).alias("versao"),
    )


def listing(df: DataFrame, columns: list[str], limit: int | None = None) -> DataFrame:
    """Values with their counts, most frequent first."""
    out = df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *[F.asc(c) for c in columns])
    return out if limit is None else out.limit(limit)


def missing_days(present: DataFrame, first: dt.date | Column, last: dt.date | Column, day: str = "event_date") -> DataFrame:
    """Calendar days of a range on which nothing was loaded."""
    ends = [c if isinstance(c, Column) else F.lit(c) for c in (first, last)]
    days = present.sparkSession.range(1).select(F.explode(F.sequence(*ends)).alias(day))
    return days.join(present.select(day).distinct(), day, "left_anti")


def hourly_gaps(events: DataFrame, source: str, hours: int, ts: str = "ts") -> DataFrame:
    """Stretches of at least ``hours`` empty hours per source.

    Events are first reduced to their distinct hours, so the window sees one row per hour however busy a source is.
    """
    busy = events.select(source, F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).distinct()
    before = F.lag("hour").over(Window.partitionBy(source).orderBy("hour"))
    gap = (micros(F.col("hour")) - micros(F.col("previous"))) / 3_600_000_000 - 1
    return busy.withColumn("previous", before).where("previous is not null").withColumn(
        "empty_hours", F.round(gap).cast("bigint")
    ).where(F.col("empty_hours") >= hours)


def click_signal(s: Silver, event_name: str, max_drop: float = 0.5) -> DataFrame:
    """Weekly opens by URL against weekly click events: a falling ratio means a broken tag."""
    week = week_start(F.col("event_date")).alias("week")
    pages = s.ga4_paginas.where(F.col("site") == s.settings.panel_site.label)
    opens = with_target(pages, s.dim_painel_relatorio, s.dim_painel)
    clicks = s.ga4_paineis.where(
        (F.col("site") == s.settings.panel_site.label) & (F.col("event_name") == event_name)
    )
    return signal_ratio(
        opens.groupBy(week).agg(F.sum("page_views").alias("n")),
        clicks.groupBy(week).agg(F.sum("event_count").alias("n")),
        "week", "n", max_drop,
    )
