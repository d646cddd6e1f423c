"""Distinct users of the last N days, on every day, and additive sums over the same windows."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WINDOW_DAYS


def rolling_active_users(
    activity: DataFrame,
    keys: list[str],
    user: str = "user_id",
    day: str = "event_date",
    windows: tuple[int, ...] = WINDOW_DAYS,
    sums: tuple[str, ...] = (),
    until: dt.date | Column | None = None,
    start: dt.date | None = None,
) -> DataFrame:
    """Exact users active in the last N days ending on each day, per key, for several N in one pass.

    Spark rejects a distinct count over a sliding frame, and repeating every user-day N times would multiply
    the data by 28. Instead each user is followed through their own active days: a run of coverage starts on a
    day no earlier visit still covers, and ends N days after the last visit of the run. Counting is then a
    running sum of +1 at starts and -1 at ends, so the work is linear in user-days whatever N is.

    Shuffles: user-days (combined on the map side, so a hot user collapses to at most one row per day and task),
    user runs, change points, and the running sum. Rows without a user count for the sums only. No window ever holds
    more than one row per calendar day.

    With ``start`` only the days from there on are returned, and only those and the longest window before them are
    read: what a user did earlier can no longer count. The filter on the day reaches the scan.

    Returns key, day, ``users_<N>d`` and the additive ``sums`` of the day, for all days up to ``until`` on which any
    of the windows or sums is not empty. ``until`` is a date or a scalar column; when it is not given the last active day is
    found with a second pass over ``activity``.
    """
    user_day = [*keys, user, day]
    activity = _in_reach(activity, day, windows, start, until)
    daily = (
        activity.groupBy(*user_day).agg(*[F.sum(c).alias(c) for c in sums]) if sums
        else activity.select(*user_day).distinct()
    )
    by_user = Window.partitionBy(*keys, user).orderBy(day)
    runs = daily.select(
        *keys, day, *sums, F.col(user).isNotNull().alias("_known"),
        F.datediff(day, F.lag(day).over(by_user)).alias("_since"),
        F.datediff(F.lead(day).over(by_user), day).alias("_gap"),
    )

    def starts(n: int) -> Column:
        uncovered = F.col("_since").isNull() | (F.col("_since") >= n)
        return F.when(F.col("_known") & uncovered, 1).otherwise(0).cast("bigint")

    def ends(n: int) -> Column:
        return F.col("_known") & (F.col("_gap").isNull() | (F.col("_gap") >= n))

    names = [f"users_{n}d" for n in windows]
    zero = F.lit(0).cast("bigint")
    visit = F.struct(F.col(day).alias("_at"), *[starts(n).alias(c) for n, c in zip(windows, names)],
                     *[F.col(c) for c in sums])
    expiries = [
        F.when(
            ends(n),
            F.struct(
                F.date_add(day, n).alias("_at"),
                *[(F.lit(-1).cast("bigint") if c == own else zero).alias(c) for c in names],
                *[F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in sums],
            ),
        )
        for n, own in zip(windows, names)
    ]
    points = runs.select(*keys, F.inline(F.array_compact(F.array(visit, *expiries))))
    changes = points.groupBy(*keys, "_at").agg(*[F.sum(c).alias(c) for c in [*names, *sums]])

    by_key = Window.partitionBy(*keys).orderBy("_at") if keys else Window.partitionBy(F.lit(0)).orderBy("_at")
    last = _last_day(activity, day, until)
    levels = changes.select(
        *keys, "_at", *sums,
        *[F.sum(c).over(by_key).alias(c) for c in names],
        F.lead("_at").over(by_key).alias("_next"),
    )
    occupied = reduce(or_, [F.col(c) > 0 for c in names])
    measured = reduce(or_, [F.col(c) != 0 for c in sums], F.lit(False))
    until_next = F.when(occupied, F.least(F.date_sub("_next", 1), last)).otherwise(F.col("_at"))
    levels = levels.where((occupied | F.coalesce(measured, F.lit(False))) & (F.col("_at") <= last))
    shown = F.col("_at") if start is None else F.greatest("_at", F.lit(start))
    if start is not None:
        levels = levels.where(until_next >= F.lit(start))
    held = F.explode(F.sequence(shown, until_next))
    return levels.select(*keys, held.alias(day), "_at", *names, *sums).select(
        *keys, day, *names,
        *[F.when(F.col(day) == F.col("_at"), F.col(c)).alias(c) for c in sums],
    )


def _in_reach(
    activity: DataFrame, day: str, windows: tuple[int, ...], start: dt.date | None, until: dt.date | Column | None
) -> DataFrame:
    """Rows of the days that can count on a day from ``start`` to ``until``."""
    if start is not None:
        activity = activity.where(F.col(day) > F.lit(start - dt.timedelta(days=max(windows))))
    if isinstance(until, dt.date):
        activity = activity.where(F.col(day) <= F.lit(until))
    return activity


def rolling_active_users_sketch(
    activity: DataFrame,
    keys: list[str],
    user: str = "user_id",
    day: str = "event_date",
    windows: tuple[int, ...] = WINDOW_DAYS,
    until: dt.date | Column | None = None,
    start: dt.date | None = None,
) -> DataFrame:
    """Estimate of :func:`rolling_active_users` from one small sketch per key and day.

    Only the daily sketches are repeated N times, never the users, so the cost after the first (map-side combined)
    aggregation depends on keys and days alone.
    """
    last = _last_day(activity, day, until)
    reached = _in_reach(activity, day, windows, start, until)
    return rolling_from_sketches(daily_user_sketches(reached, keys, user, day), keys, day, windows, last, start)


def daily_user_sketches(activity: DataFrame, keys: list[str], user: str = "user_id", day: str = "event_date") -> DataFrame:
    """Key, day and a sketch of the day's users, a few KB each: what to store, so that users are read once only."""
    return activity.groupBy(*keys, day).agg(F.hll_sketch_agg(user).alias("sketch"))


def rolling_from_sketches(
    daily: DataFrame, keys: list[str], day: str = "event_date", windows: tuple[int, ...] = WINDOW_DAYS,
    until: dt.date | Column | None = None, start: dt.date | None = None,
) -> DataFrame:
    """Estimated users of the last N days from daily sketches, stored or just made, for days up to ``until``.

    Sketches of one key and day from several sources are merged. With ``start`` only the days that count are read.
    """
    widest = max(windows)
    last = _last_day(daily, day, until)
    first = F.col(day) if start is None else F.greatest(day, F.lit(start))
    reached = _in_reach(daily, day, windows, start, until).where(F.col(day) <= last)
    spread = reached.select(
        *keys, F.col(day).alias("_seen"), "sketch",
        F.explode(F.sequence(first, F.least(F.date_add(day, widest - 1), last))).alias(day),
    )
    age = F.datediff(day, "_seen")
    return spread.groupBy(*keys, day).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(age < n, F.col("sketch")))), F.lit(0).cast("bigint"))
        .alias(f"users_{n}d")
        for n in windows
    ])


def _last_day(activity: DataFrame, day: str, until: dt.date | Column | None) -> Column:
    if until is None:
        return activity.agg(F.max(day)).scalar()
    return until if isinstance(until, Column) else F.lit(until)


def rolling_sums(
    df: DataFrame, keys: list[str], sums: dict[int, dict[str, str]], day: str = "event_date"
) -> DataFrame:
    """Sums over the last N calendar days (RANGE, so absent days do not stretch the frame).

    ``sums``: N -> {output: input}. The day number is a column of its own, so that all frames share one sort.
    The input is one row per key and day, so a window holds at most one row per calendar day.
    """
    numbered = df.withColumn("_day_no", F.unix_date(day))
    base = Window.partitionBy(*keys).orderBy("_day_no")
    out = [
        F.sum(src).over(base.rangeBetween(-(n - 1), 0)).alias(name)
        for n, cols in sums.items()
        for name, src in cols.items()
    ]
    return numbered.select(*df.columns, *out)
