"""Typed, flat feed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Feed, Settings
from ..functions.text import or_not_set
from ..functions.traffic import site_of
from ..functions.url import redirect_target
from ..operators.segments import flag_by_join
from ..schemas import silver_schema

_NUMBERS = {"count": "bigint", "seconds": "decimal(14,2)"}


def _converted(source: str, kind: str) -> Column:
    """The typed value, NULL where the text cannot be read."""
    col = F.col(f"`{source}`")
    if kind == "date":
        return F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date")
    if kind == "dim":
        return or_not_set(col)
    return col.try_cast(_NUMBERS[kind]) if kind in _NUMBERS else col


def _unreadable(source: str, kind: str) -> Column:
    return F.col(f"`{source}`").isNotNull() & _converted(source, kind).isNull()


def _typed(source: str, kind: str) -> Column:
    if kind in ("dim", "text"):
        return _converted(source, kind)
    message = F.concat(F.lit(f"{source} cannot be read as {kind}: "), F.col(f"`{source}`"))
    return F.when(_unreadable(source, kind), F.raise_error(message)).otherwise(_converted(source, kind))


def typed_rows(records: DataFrame, feed: Feed, settings: Settings) -> DataFrame:
    """Delivered text to typed columns. Bad numbers or dates raise and stop the load, whatever the cast settings."""
    cols = [_typed(src, kind).alias(name) for src, (name, kind) in feed.fields.items()]
    out = records.select(*cols, "data_extracao").withColumn("site", site_of(F.col("hostname"), settings))
    if feed.name == "paginas":
        out = out.withColumn("alvo", redirect_target(F.col("page_location")))
    return out


def split_bad(records: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(loadable, quarantine): rows with a number or date that cannot be read are set aside instead of raising."""
    bad = F.lit(False)
    for src, (_, kind) in feed.fields.items():
        if kind not in ("dim", "text"):
            bad = bad | _unreadable(src, kind)
        if kind == "date":
            bad = bad | F.col(f"`{src}`").isNull()
    return records.where(~bad), records.where(bad)


def silver_rows(records: DataFrame, feed: Feed, settings: Settings) -> DataFrame:
    """Rows in the published column order; the site feed carries the segment's validity."""
    rows = typed_rows(records, feed, settings)
    if feed.name == "site":
        rows = flag_by_join(rows, settings)
    return rows.select(*silver_schema(feed).names)
