"""Validity of a traffic segment, decided once and given to each of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SEGMENT, SESSION_EVENT, Settings
from ..functions.traffic import valid_traffic


def _is_valid(settings: Settings):
    rule = valid_traffic(F.col("sessions"), F.col("engaged_sessions"), settings.robots)
    on_start = F.max(F.when(F.col("event_name") == SESSION_EVENT, rule))
    any_engaged = F.max(F.col("engaged_sessions") > 0)
    return on_start, any_engaged


def flag_by_window(rows: DataFrame, settings: Settings) -> DataFrame:
    """Flag rows that were just aggregated to (segment, event name).

    One shuffle. Such input has one row per event name in a segment, which is what bounds the window; use
    :func:`flag_by_join` for rows of unknown multiplicity.
    """
    on_start, any_engaged = _is_valid(settings)
    segment = Window.partitionBy(*SEGMENT)
    return rows.withColumn(
        "trafego_valido",
        F.coalesce(on_start.over(segment), any_engaged.over(segment), F.col("engaged_sessions") > 0),
    )


def flag_by_join(rows: DataFrame, settings: Settings) -> DataFrame:
    """Flag rows of any multiplicity, e.g. landed rows where one segment may be repeated without bound.

    The flags are aggregated (combined on the map side) and joined back. Joining on a hash beside the keys makes
    Spark shuffle both sides for the join itself, which is the plan shape whose skewed partitions AQE splits; when
    the flags turn out small, AQE broadcasts them by their measured size and the rows are not shuffled at all.
    """
    on_start, any_engaged = _is_valid(settings)
    hashed = F.xxhash64(*SEGMENT)
    flags = (
        rows.groupBy(*SEGMENT)
        .agg(F.coalesce(on_start, any_engaged).alias("_flag"))
        .withColumn("_segment", hashed)
    )
    joined = rows.withColumn("_segment", hashed).join(flags, [*SEGMENT, "_segment"], "left")
    return joined.withColumn(
        "trafego_valido", F.coalesce("_flag", F.col("engaged_sessions") > 0)
    ).select(*rows.columns, "trafego_valido")
