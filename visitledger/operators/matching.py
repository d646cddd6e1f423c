"""Interval matching of events, and comparison of two aggregated sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import micros
from ..functions.text import ratio


def last_label_before(
    events: DataFrame,
    user: str,
    ts: str,
    event_id: str,
    is_label: Column,
    is_target: Column,
    label: Column,
    target: Column,
    seconds: int,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """For each target event, the label of the same user's latest label event in the preceding ``seconds``.

    Time is cut into buckets and a window is taken per (user, bucket), so one hot user spreads over as many tasks
    as there are buckets. A label event so late in its bucket that the next bucket can still see it is copied
    there, and only there. Within a bucket the latest label is carried along a running frame: no pairs are formed,
    and the work is linear. Targets sort before labels of the same instant, which do not count as preceding; labels
    of one instant are settled by the larger id. Events without a user match nothing.
    """
    if bucket_seconds < seconds:
        raise ValueError("a bucket must be at least as long as the interval")
    span = bucket_seconds * 1_000_000
    reach = seconds * 1_000_000
    roles = F.explode(F.array_compact(F.array(F.when(is_target, F.lit(0)), F.when(is_label, F.lit(1)))))
    base = events.where(F.col(user).isNotNull() & (is_label | is_target)).select(
        F.col(user).alias("_user"), micros(F.col(ts)).alias("_us"), F.col(event_id).alias("_id"),
        label.alias("_label"), target.alias("_target"), roles.alias("_role"),
    ).withColumn("_own", F.floor(F.col("_us") / span))
    is_copied = (F.col("_role") == 1) & (F.col("_us") + reach >= (F.col("_own") + 1) * span)
    buckets = F.when(is_copied, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))
    placed = base.withColumn("_bucket", F.explode(buckets))
    before = Window.partitionBy("_user", "_bucket").orderBy("_us", "_role", "_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    label_event = F.when(F.col("_role") == 1, F.struct("_us", "_label"))
    return (
        placed.withColumn("_seen", F.last(label_event, ignorenulls=True).over(before))
        .where((F.col("_role") == 0) & (F.col("_seen._us") >= F.col("_us") - reach))
        .select(
            F.col("_user").alias(user), F.col("_id").alias(event_id),
            F.col("_target").alias("target"), F.col("_seen._label").alias("label"),
        )
    )


def dominant_label(matches: DataFrame) -> DataFrame:
    """Most frequent label of each target, its count and the target's total; ties go to the smaller label."""
    counts = matches.groupBy("target", "label").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("label", "n"), F.struct(-F.col("n"), F.col("label")))
    return counts.groupBy("target").agg(best.alias("_best"), F.sum("n").alias("matches")).select(
        "target", F.col("_best.label").alias("label"), F.col("_best.n").alias("n"), "matches"
    )


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Full outer comparison of one additive metric; a side without the key counts as 0."""
    a = left.groupBy(*keys).agg(F.sum(metric).alias("_left"))
    b = right.groupBy(*keys).agg(F.sum(metric).alias("_right"))
    zero = F.lit(0)
    return a.join(b, keys, "full").select(
        *keys,
        F.coalesce("_left", zero).alias("left_value"),
        F.coalesce("_right", zero).alias("right_value"),
    ).withColumn("difference", F.col("left_value") - F.col("right_value")).withColumn(
        "relative_difference", ratio(F.col("difference"), F.col("right_value"))
    )


def signal_ratio(
    opens: DataFrame, clicks: DataFrame, period: str, count: str, max_drop: float = 0.5
) -> DataFrame:
    """Clicks against opens per period over the union of periods, flagging a collapse of the click signal.

    ``broken`` is true when the ratio fell by more than ``max_drop`` against the previous period. Both sides are
    already one row per period.
    """
    both = opens.select(period, F.col(count).alias("opens")).join(
        clicks.select(period, F.col(count).alias("clicks")), period, "full"
    ).fillna(0, ["opens", "clicks"])
    rated = both.withColumn("ratio", F.coalesce(ratio(F.col("clicks"), F.col("opens")), F.lit(0.0)))
    by_period = Window.partitionBy(F.lit(0)).orderBy(period)
    previous = F.lag("ratio").over(by_period)
    return rated.withColumn(
        "broken", F.coalesce(F.col("ratio") < previous * (1 - max_drop), F.lit(False))
    )
