"""Top-k lists, shares, and changes between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ratio
from ..session import shared_dir


def top(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """Ordered list, cut to k rows (kept per task before the merge, so nothing is sorted whole)."""
    out = df.orderBy(*order)
    return out if k is None else out.limit(k)


def numbered(listing: DataFrame, *order: Column) -> DataFrame:
    """1-based position in a list that was already cut to its top rows; see :func:`numbered_at_scale` for whole tables."""
    return listing.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def numbered_at_scale(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """1-based position of every row of a table of any size in the given order, no task seeing more than its range.

    Rows are dealt by ranges of the order and sorted there; each range counts its rows, and the sums of the counts
    before it, one row for each range, are where its own numbers begin. Rows that tie are numbered in no particular order,
    once and for all, as the sorted rows are written to the shared folder: running a job is the price of it.
    """
    spark, own = df.sparkSession, "_place"
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    path = shared_dir(spark, "numbered")
    sorted_rows.withColumn(own, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(own, T.LongType())])).parquet(path)
    part, within = F.shiftright(own, 33), F.col(own).bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.withColumn("_part", part).join(starts, "_part").select(
        *[F.col("`" + c.replace("`", "``") + "`") for c in df.columns], (F.col("_start") + within + 1).alias(name))


def against_top(listing: DataFrame, value: str, least: int = 2) -> DataFrame:
    """Bar width in percent of the largest value: half to even, never below ``least``. The largest is one scalar of its
    own, so the rows are not gathered anywhere."""
    largest = listing.agg(F.max(value)).scalar()
    width = F.bround(100 * ratio(F.col(value), largest), 0).cast("int")
    return listing.withColumn("width_pct", F.greatest(F.lit(least), width))


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Share of the grand total. The total is one scalar of its own, so the rows are not gathered anywhere."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, ratio(F.col(value), total))


def keep_top_members(facts: DataFrame, member: str, measure: Column, k: int) -> DataFrame:
    """Rows of the k members with the largest measure; ties go to the smaller name."""
    best = facts.groupBy(member).agg(measure.alias("_m")).where(F.col(member).isNotNull())
    chosen = best.orderBy(F.desc_nulls_last("_m"), F.asc(member)).limit(k).select(member)
    return facts.join(chosen, member, "left_semi")


def period_change(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Value, previous value and relative change per key over consecutive periods (one row per key and period)."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
    return df.withColumn("previous", previous).withColumn(
        "change", ratio(F.col(value) - F.col("previous"), F.col("previous"))
    )
