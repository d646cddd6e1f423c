"""Dimensions x metrics reports over raw events, described by a small spec."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import relative_day
from ..functions.text import ratio


@dataclass(frozen=True)
class EventColumns:
    """Which columns of the event table carry the roles a report needs."""

    day: str = "event_date"
    user: str = "user_id"
    session: str = "session_id"
    engaged: str = "engaged"
    seconds: str = "engagement_s"


# ---- filters -------------------------------------------------------------------------------------------------------

def in_list(column: str, values: list[str]) -> Column:
    return F.col(column).isin(*values)


def exact(column: str, value: str) -> Column:
    return F.col(column) == value


def contains(column: str, value: str) -> Column:
    return F.col(column).contains(value)


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates)


# ---- metrics -------------------------------------------------------------------------------------------------------

_SESSION_METRICS = {"sessions", "engagedSessions", "engagementRate"}


def _exact(rows: DataFrame, dims: list[str], metrics: tuple[str, ...], c: EventColumns) -> DataFrame:
    """Counts by levels: sessions, then users, then the dimensions.

    Several distinct counts in one aggregation would make Spark expand every row once per count. A session belongs
    to one user, so plain aggregations in this order give the same numbers, each combined on the map side.
    """
    rows = rows.withColumn("_n", F.lit(1).cast("bigint"))
    seconds = F.sum(c.seconds).alias(c.seconds) if "userEngagementDuration" in metrics else None
    kept = [seconds] if seconds is not None else []
    if _SESSION_METRICS & set(metrics):
        rows = rows.groupBy(*dims, c.user, c.session).agg(
            F.sum("_n").alias("_n"), F.bool_or(c.engaged).alias("_e"), *kept
        ).select(
            "*", F.when(F.col(c.session).isNotNull(), 1).otherwise(0).cast("bigint").alias("_s"),
            F.when(F.col(c.session).isNotNull() & F.col("_e"), 1).otherwise(0).cast("bigint").alias("_es"),
        )
    else:
        zero = F.lit(0).cast("bigint")
        rows = rows.withColumn("_s", zero).withColumn("_es", zero)
    if "activeUsers" in metrics:
        rows = rows.groupBy(*dims, c.user).agg(*[F.sum(x).alias(x) for x in ("_n", "_s", "_es")], *kept)
        users = F.count(c.user)
    else:
        users = F.lit(None).cast("bigint")
    out = rows.groupBy(*dims).agg(*[F.sum(x).alias(x) for x in ("_n", "_s", "_es")], users.alias("_u"), *kept)
    made = {
        "eventCount": F.col("_n"), "sessions": F.col("_s"), "engagedSessions": F.col("_es"), "activeUsers": F.col("_u"),
        "userEngagementDuration": F.col(c.seconds) if kept else None,
        "engagementRate": ratio(F.col("_es"), F.col("_s")),
    }
    return out.select(*dims, *[made[m].alias(m) for m in metrics])


def _estimated(rows: DataFrame, dims: list[str], metrics: tuple[str, ...], c: EventColumns) -> DataFrame:
    """One pass with sketches for every distinct count, as the report service itself does for users."""
    sessions = F.approx_count_distinct(c.session)
    engaged = F.approx_count_distinct(F.when(F.col(c.engaged), F.col(c.session)))
    made = {
        "eventCount": lambda: F.count("*"), "sessions": lambda: sessions, "engagedSessions": lambda: engaged,
        "activeUsers": lambda: F.approx_count_distinct(c.user),
        "userEngagementDuration": lambda: F.sum(c.seconds), "engagementRate": lambda: ratio(engaged, sessions),
    }
    return rows.groupBy(*dims).agg(*[made[m]().alias(m) for m in metrics])


def time_grain(grain: str, ts: str = "ts") -> Column:
    """minute, hour, day or month as a timestamp, or ``yearMonth`` style text for display."""
    if grain == "yearMonth":
        return F.date_format(ts, "yyyyMM").alias(grain)
    return F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz").alias(grain)


@dataclass(frozen=True)
class ReportSpec:
    dimensions: tuple[str | Column, ...]
    metrics: tuple[str, ...]
    start: str | None = None
    end: str | None = None
    where: Column | None = None
    keep_empty_rows: bool = False
    order_by: tuple[tuple[str, bool], ...] = ()  # (column, descending)
    limit: int | None = None
    offset: int = 0
    estimate: bool = False
    columns: EventColumns = field(default_factory=EventColumns)


def run_report(events: DataFrame, spec: ReportSpec, today: dt.date | None = None) -> DataFrame:
    """One scan; the date range and filters reach it, and every aggregation combines on the map side."""
    cols = spec.columns
    rows = events
    if spec.start:
        rows = rows.where(F.col(cols.day) >= F.lit(relative_day(spec.start, today)))
    if spec.end:
        rows = rows.where(F.col(cols.day) <= F.lit(relative_day(spec.end, today)))
    if spec.where is not None:
        rows = rows.where(spec.where)
    dims = rows.select(*spec.dimensions).columns
    plain = [c for c in (cols.user, cols.session, cols.engaged, cols.seconds) if c in rows.columns and c not in dims]
    count = _estimated if spec.estimate else _exact
    out = count(rows.select(*spec.dimensions, *plain), dims, spec.metrics, cols)
    if not spec.keep_empty_rows:
        out = out.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(m) > 0, F.lit(False)) for m in spec.metrics]))
    if spec.order_by:
        out = out.orderBy(*[F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in spec.order_by])
    if spec.offset:
        out = out.offset(spec.offset)
    return out if spec.limit is None else out.limit(spec.limit)


def period_users(events: DataFrame, keys: list[str], start: dt.date, end: dt.date, day: str = "event_date",
                 user: str = "user_id") -> DataFrame:
    """Distinct users of a closed period, without a date dimension."""
    rows = events.where(F.col(day).between(F.lit(start), F.lit(end)))
    return rows.groupBy(*keys).agg(F.count_distinct(user).alias("users"))
