"""Append-only snapshots of delivered records, the newest-snapshot choice, and load windows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Feed, Settings
from ..functions.dates import from_compact, instant
from ..schemas import CONTROL_LOG, payload_schema
from .tables import Warehouse


def append_snapshot(
    wh: Warehouse, feed: Feed, records: DataFrame, extracted_at: dt.datetime, snapshot_id: str | None = None,
    empty_days: tuple[dt.date, dt.date] | None = None,
) -> str:
    """Store one extraction: a snapshot per day, rows kept flat with values exactly as delivered.

    A day is a folder of rows, not one cell holding the whole day, so no task ever has to assemble a day. The
    snapshot id is part of the folder, so earlier snapshots are never touched and repeating an interrupted append
    under the same id overwrites only itself. The number of rows per day goes to the snapshot log last; until then
    nothing reads the rows.

    A day that returned nothing keeps its earlier snapshot, unless the requested range is given as ``empty_days``:
    then every day of it without rows gets an empty snapshot, which clears the day.
    """
    sid = snapshot_id or uuid.uuid4().hex
    rows = records.withColumn("data_extracao", instant(extracted_at)).withColumn("snapshot_id", F.lit(sid))
    empty = None
    if empty_days:
        empty = wh.spark.range(1).select(
            F.explode(F.sequence(*map(F.lit, empty_days))).alias("event_date"), F.lit(sid).alias("snapshot_id"),
            instant(extracted_at).alias("data_extracao"))
    append_snapshots(wh, feed, rows, [sid], f"{feed.name}-{sid}", empty)
    return sid


def append_snapshots(
    wh: Warehouse, feed: Feed, rows: DataFrame, ids: list[str], entry: str, empty: DataFrame | None = None,
) -> None:
    """Store the snapshots ``ids``, whose id and time are columns of ``rows``, and note them as one entry of the log.

    ``empty``: days (event_date, snapshot_id, data_extracao) that get an empty snapshot if there are no rows for them.
    """
    _store(wh, feed, rows)
    log = _stored(wh, feed, F.col("snapshot_id").isin(ids))
    if empty is not None:
        blank = empty.join(log, ["event_date", "snapshot_id"], "left_anti").select(
            F.lit(feed.name).alias("relatorio"), "event_date", "snapshot_id", F.lit(0).cast("bigint").alias("linhas"),
            "data_extracao")
        log = log.unionByName(blank)
    wh.note("snapshots", log, entry)


def import_payloads(wh: Warehouse, feed: Feed, snapshots: DataFrame) -> None:
    """Take over snapshots kept elsewhere as one JSON array per day (``payload``, ``data_extracao``).

    A call notes its own extraction times only; the same call again replaces its lines.
    """
    imported = snapshots.select("payload", "data_extracao").withColumn("snapshot_id", _import_id(F.col("data_extracao")))
    ids = sorted(r["snapshot_id"] for r in imported.select("snapshot_id").distinct().collect())
    if ids:
        append_snapshots(wh, feed, explode_payload(imported, feed), ids, f"{feed.name}-{ids[0]}-{ids[-1]}")


def _import_id(extracted_at: Column) -> Column:
    return F.concat(F.lit("import-"), F.date_format(extracted_at, "yyyyMMddHHmmssSSSSSS"))


def _store(wh: Warehouse, feed: Feed, rows: DataFrame) -> None:
    """Write (day, snapshot) folders; only folders that are in ``rows`` are touched."""
    rows.select(
        *[F.col(f"`{c}`") for c in feed.fields], "data_extracao", from_compact(F.col("date")).alias("event_date"),
        "snapshot_id",
    ).hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "event_date", "snapshot_id"
    ).parquet(wh.path("bronze", feed.name))


def _stored(wh: Warehouse, feed: Feed, chosen: Column) -> DataFrame:
    """Log lines of stored snapshots."""
    rows = wh.bronze(feed).where(chosen)
    return rows.groupBy("event_date", "snapshot_id", "data_extracao").agg(F.count("*").alias("linhas")).select(
        F.lit(feed.name).alias("relatorio"), "event_date", "snapshot_id", "linhas", "data_extracao"
    )


def explode_payload(snapshots: DataFrame, feed: Feed) -> DataFrame:
    """Rows of snapshots kept as one JSON array per day (``payload``); every other column is repeated.

    A payload that cannot be read stops the job: leaving it out would drop its whole day. The parsed array is bound to
    a name, so that testing it does not parse it again.
    """
    schema = "array<struct<" + ",".join(f"`{c}`:string" for c in payload_schema(feed).names) + ">>"
    others = [c for c in snapshots.columns if c != "payload"]
    bound = F.transform(F.array(F.from_json("payload", schema)), lambda rows: F.when(
        rows.isNull() & F.col("payload").isNotNull(),
        F.raise_error(F.lit("a snapshot payload is not a readable JSON array"))).otherwise(rows))
    return snapshots.select(*others, F.inline(bound[0]))


def newest_snapshots(log: DataFrame) -> DataFrame:
    """day -> its newest snapshot; extraction times that tie are settled by the snapshot id."""
    newest = F.max(F.struct("data_extracao", "snapshot_id", *(["linhas"] if "linhas" in log.columns else [])))
    return log.groupBy("event_date").agg(newest.alias("_n")).select(
        "event_date", "_n.*"
    ).select("event_date", "snapshot_id", "data_extracao", *(["linhas"] if "linhas" in log.columns else []))


def newest_rows(bronze: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of the newest snapshots. Day and snapshot are partition columns, so the join prunes whole folders."""
    return bronze.join(newest.select("event_date", "snapshot_id"), ["event_date", "snapshot_id"], "left_semi")


def pending_days(log: DataFrame, silver_days: DataFrame) -> DataFrame:
    """Days whose newest snapshot is newer than what silver holds (or that silver does not hold at all).

    ``silver_days`` is anything with ``event_date`` and ``data_extracao``: the small log of loaded days, or the
    silver table itself.
    """
    held = silver_days.groupBy("event_date").agg(F.max("data_extracao").alias("_held"))
    return newest_snapshots(log).join(held, "event_date", "left").where(
        F.col("_held").isNull() | (F.col("data_extracao") > F.col("_held"))
    ).drop("_held")


# ---- load windows --------------------------------------------------------------------------------------------------

def month_ranges(days: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Month-sized ranges covering [start, end] of each row, clipped at both ends."""
    months = F.explode(F.sequence(F.trunc(start, "MM"), F.col(end), F.expr("interval 1 month"))).alias("_m")
    return days.select("*", months).select(
        *days.columns,
        F.greatest(F.col(start), F.col("_m")).alias("range_start"),
        F.least(F.col(end), F.last_day("_m")).alias("range_end"),
    )


def islands(days: DataFrame, keys: list[str], day: str = "event_date") -> DataFrame:
    """Runs of days without a gap: keys, range_start, range_end. Repeated days count once."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(day))
    runs = days.select(*keys, day).distinct().withColumn("_run", F.date_sub(day, place))
    return runs.groupBy(*keys, "_run").agg(F.min(day).alias("range_start"), F.max(day).alias("range_end")).drop("_run")


def extraction_ranges(
    control: DataFrame, log: DataFrame, floors: DataFrame, today: dt.date, settings: Settings, history: bool = False,
) -> DataFrame:
    """The fewest ranges (relatorio, range_start, range_end) that hold every day to extract, cut at months.

    Days to extract are those of the report's window; with ``history`` also every day since its floor without a snapshot.
    """
    window = load_window(control, floors, today, settings)
    days = window.select("relatorio", F.explode(F.sequence("window_start", "window_end")).alias("event_date"))
    if history:
        yesterday = F.lit(today - dt.timedelta(days=1))
        since = floors.where(F.col("floor") <= yesterday).select(
            "relatorio", F.explode(F.sequence("floor", yesterday)).alias("event_date"))
        days = days.unionByName(since.join(log.select("relatorio", "event_date"), ["relatorio", "event_date"], "left_anti"))
    runs = islands(days, ["relatorio"])
    return month_ranges(runs.withColumnsRenamed({"range_start": "start", "range_end": "end"})).select(
        "relatorio", "range_start", "range_end")


def last_window_end(control: DataFrame) -> DataFrame:
    return control.groupBy("relatorio").agg(F.max("data_fim_janela").alias("last_end"))


def load_window(control: DataFrame, floors: DataFrame, today: dt.date, settings: Settings) -> DataFrame:
    """Per report the days to pull: [min(today - N, last end - N), yesterday], widening after an outage.

    ``floors``: relatorio, floor (the earliest day of a first run). Empty windows are left out.
    """
    n = settings.lookback_days
    usual = F.lit(today - dt.timedelta(days=n))
    start = F.when(F.col("last_end").isNull(), F.greatest("floor", usual)).otherwise(
        F.least(usual, F.date_sub("last_end", n))
    )
    return floors.join(last_window_end(control), "relatorio", "left").select(
        "relatorio", start.alias("window_start"), F.lit(today - dt.timedelta(days=1)).alias("window_end")
    ).where("window_start <= window_end")


def register_load(
    wh: Warehouse, report: str, kind: str, start: dt.date, end: dt.date, days: int, rows: int, at: dt.datetime,
    entry: str | None = None,
) -> None:
    """One line in the control log; ``kind`` is ``historico`` or ``incremental``. The same entry again replaces it."""
    line = wh.spark.createDataFrame([(report, kind, start, end, days, rows, at)], CONTROL_LOG)
    wh.note("control", line, entry)
