"""Delivered pages until their extraction is whole: a ledger of pages, staged rows, and what is set aside.

Files are parsed once: the rows of a load go to its own staging folder, and one line per file to the page ledger. An
extraction is whole when its pages follow each other without a gap, none of them is truncated or lacks a header of the
feed, and they hold as many rows as the service said the report has. Only whole extractions become snapshots, each
once; others wait in the ledger for what is still to come, and a page delivered again takes the place of the earlier
file. Everything is written under the name of the load, so a load that is repeated after a crash changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Feed
from ..schemas import PAGE_LOG, payload_schema
from . import bronze, landed
from .tables import Warehouse, entry_folder

_KEY = ["extraction", "page", "path"]


class IncompleteDelivery(Exception):
    """A load whose extraction is not whole."""


def _staged_schema(feed: Feed) -> T.StructType:
    own = [f for f in PAGE_LOG.fields if f.name in ("extraction", "page", "path", "delivered_at", "declared", "missing")]
    return T.StructType([*own, T.StructField(landed.CORRUPT, T.StringType()), T.StructField("row_no", T.IntegerType()),
                         *payload_schema(feed).fields, T.StructField("entry", T.StringType())])


def staged(wh: Warehouse, feed: Feed) -> DataFrame:
    return wh.spark.read.schema(_staged_schema(feed)).parquet(wh.path("landing", feed.name))


def page_lines(rows: DataFrame, feed: Feed) -> DataFrame:
    """The ledger lines of page rows: one for each file."""
    is_row = F.col("row_no").isNotNull()
    return rows.groupBy(*_KEY).agg(
        F.max("delivered_at").alias("delivered_at"), F.max("declared").alias("declared"),
        F.count("row_no").alias("rows"), F.count_if(is_row & ~landed.has_day()).alias("undated"),
        F.max("missing").alias("missing"), F.bool_or(F.col(landed.CORRUPT).isNotNull()).alias("corrupt"),
    ).withColumn("relatorio", F.lit(feed.name)).select(*PAGE_LOG.names)


def stage(wh: Warehouse, feed: Feed, pages: DataFrame, entry: str) -> None:
    """Rows of the delivered pages to the load's staging folder, corrupt files to quarantine, one line each to the ledger."""
    folder = entry_folder(entry)
    landed.page_rows(pages, feed).write.mode("overwrite").parquet(wh.path("landing", feed.name, folder))
    mine = staged(wh, feed).where(F.col("entry") == entry)
    _aside(mine.where(F.col(landed.CORRUPT).isNotNull()).select(*_KEY, "delivered_at", landed.CORRUPT),
           wh, "quarantine", f"{feed.name}_files", folder)
    wh.note("pages", page_lines(mine, feed), entry)


def _aside(rows: DataFrame, wh: Warehouse, *parts: str) -> None:
    if not rows.isEmpty():
        rows.write.mode("overwrite").parquet(wh.path(*parts))


def usable_pages(ledger: DataFrame) -> DataFrame:
    """The file that counts for each page of each extraction: the newest that is neither corrupt nor lacks a header.

    A page of which no file is usable is there too, with ``fault`` telling why.
    """
    fault = F.when(F.col("corrupt"), "corrupt").when(F.size("missing") > 0, "headers")
    facts = F.struct("path", "delivered_at", "declared", "rows", fault.alias("fault"))
    order = F.struct(fault.isNull().alias("usable"), "delivered_at", "path")
    return ledger.groupBy("relatorio", "extraction", "page").agg(F.max_by(facts, order).alias("file")).select(
        "relatorio", "extraction", "page", "file.*")


def reconciled(ledger: DataFrame) -> DataFrame:
    """One row per extraction: pages, rows and the declared number of rows, and its state.

    ``whole``; ``corrupt`` or ``headers``: a page has no usable file; ``short`` or ``surplus``: pages or rows are
    missing, or there are more rows than declared. Without a declared number the first page is all there is.
    """
    number = F.col("page").try_cast("int")
    found = usable_pages(ledger).groupBy("relatorio", "extraction").agg(
        F.count("*").alias("pages"), F.sum("rows").alias("rows"), F.max("declared").alias("declared"),
        F.max("delivered_at").alias("delivered_at"), F.min("fault").alias("fault"),
        (F.max(number) - F.least(F.min(number), F.lit(1)) + 1 - F.count(number)).alias("absent"),
    )
    declared = F.coalesce("declared", F.lit(0))
    state = (F.when(F.col("fault").isNotNull(), F.col("fault"))
             .when((F.coalesce("absent", F.lit(0)) > 0) | (F.col("rows") < declared), "short")
             .when((declared > 0) & (F.col("rows") > declared), "surplus").otherwise("whole"))
    return found.select("relatorio", "extraction", "pages", "rows", "declared", "delivered_at", state.alias("state"))


def open_extractions(wh: Warehouse, feed: Feed, entry: str) -> DataFrame:
    """State of the extractions of a feed that no load but ``entry`` has used."""
    used = wh.log("taken").where((F.col("relatorio") == feed.name) & (F.col("entry") != entry)).select("extraction")
    ledger = wh.log("pages").where(F.col("relatorio") == feed.name)
    return reconciled(ledger.join(used, "extraction", "left_anti"))


def take(
    wh: Warehouse, feed: Feed, whole: DataFrame, entry: str, kind: str, at: dt.datetime,
    window: tuple[dt.date, dt.date] | None = None, empty: DataFrame | None = None,
) -> list[str]:
    """Whole extractions (extraction, snapshot_id, data_extracao, pages, rows) become snapshots; returns their ids.

    The few extractions of a load come to the driver; their rows are stored in one job. The control log gets a line for
    each, the ``taken`` log is written last.
    """
    found = sorted(whole.collect(), key=lambda r: (r["data_extracao"], r["snapshot_id"]))
    if not found:
        return []
    ids = [r["snapshot_id"] for r in found]
    chosen = wh.spark.createDataFrame(
        [(r["extraction"], r["snapshot_id"], r["data_extracao"]) for r in found],
        "extraction string, snapshot_id string, data_extracao timestamp_ntz")
    files = usable_pages(wh.log("pages").where(F.col("relatorio") == feed.name)).select(*_KEY).join(chosen, "extraction")
    rows = staged(wh, feed).where("row_no IS NOT NULL").join(files, _KEY)
    bronze.append_snapshots(wh, feed, rows.where(landed.has_day()), ids, entry, empty)
    _aside(rows.where(~landed.has_day()).select(*[F.col(f"`{c}`") for c in feed.fields], "snapshot_id"),
           wh, "quarantine", feed.name, entry_folder(entry))
    stored = wh.log("snapshots").where((F.col("relatorio") == feed.name) & (F.col("entry") == entry) & (F.col("linhas") > 0))
    spans = {r["snapshot_id"]: r for r in stored.groupBy("snapshot_id").agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last"), F.count("*").alias("days"),
        F.sum("linhas").alias("rows")).collect()}
    for sid in ids:
        span = spans.get(sid)
        start, end = window or ((span["first"], span["last"]) if span else (None, None))
        if start:
            days, n = (span["days"], span["rows"]) if span else (0, 0)
            bronze.register_load(wh, feed.name, kind, start, end, days, n, at, f"{feed.name}-{sid}")
    wh.note("taken", wh.spark.createDataFrame(
        [(feed.name, r["extraction"], r["snapshot_id"], r["data_extracao"], r["pages"], r["rows"]) for r in found],
        wh.log("taken").drop("entry").schema), entry)
    return ids


def sweep(wh: Warehouse, feed: Feed, entry: str) -> None:
    """Remove staged rows of loads whose extractions were all used by earlier loads than ``entry``."""
    used = wh.log("taken").where((F.col("relatorio") == feed.name) & (F.col("entry") != entry)).select("extraction")
    pages = wh.log("pages").where((F.col("relatorio") == feed.name) & (F.col("entry") != entry))
    needed = pages.join(used, "extraction", "left_anti").select("entry").distinct()
    for row in pages.select("entry").distinct().join(needed, "entry", "left_anti").collect():
        wh.delete("landing", feed.name, entry_folder(row["entry"]))
