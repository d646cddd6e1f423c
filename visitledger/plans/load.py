"""Daily and historical loads: landed responses -> bronze -> silver, plus the post-load counts."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEEDS, Feed, Settings
from ..operators.constraints import enforced
from ..schemas import CONSTRAINTS
from ..sources import bronze, delivery, landed
from ..sources.silver import silver_rows
from ..sources.tables import Warehouse, entry_folder
from .gold import VIEWS, Silver


def land(
    wh: Warehouse, feed: Feed, path: str, extracted_at: dt.datetime, kind: str = "incremental",
    snapshot_id: str | None = None, window: tuple[dt.date, dt.date] | None = None, clear_empty_days: bool = False,
) -> str:
    """Store the response files of one extraction as a snapshot and note its window in the control log.

    An extraction that is not whole is refused: truncated files go to quarantine, the ledger says what is missing, and
    nothing becomes a snapshot. Rows without a readable day go to the quarantine folder. Without a requested window the
    first and last delivered day are noted.
    """
    sid = snapshot_id or uuid.uuid4().hex
    entry = f"{feed.name}-{sid}"
    delivery.stage(wh, feed, landed.read_pages(wh.spark.read, path, sid), entry)
    found = delivery.reconciled(wh.log("pages").where(F.col("entry") == entry)).first()
    if found and found["state"] != "whole":
        raise delivery.IncompleteDelivery(
            f"{feed.name} {sid}: {found['state']}, {found['rows']} of {found['declared']} rows on {found['pages']} pages")
    one = wh.spark.createDataFrame(
        [(sid, sid, extracted_at, found["pages"] if found else 0, found["rows"] if found else 0)],
        "extraction string, snapshot_id string, data_extracao timestamp_ntz, pages long, rows long")
    empty = None
    if window and clear_empty_days:
        empty = one.select(F.explode(F.sequence(*map(F.lit, window))).alias("event_date"), "snapshot_id", "data_extracao")
    delivery.take(wh, feed, one, entry, kind, extracted_at, window, empty)
    wh.delete("landing", feed.name, entry_folder(entry))
    return sid


def pending(wh: Warehouse, feed: Feed) -> DataFrame:
    """From two small logs; the fact table is not read."""
    return bronze.pending_days(
        wh.snapshots().where(F.col("relatorio") == feed.name), wh.loaded().where(F.col("tabela") == feed.table)
    )


def refresh_silver(wh: Warehouse, feed: Feed, settings: Settings) -> list[dt.date]:
    """Replace the days whose newest snapshot is newer than what silver holds. Running it again does nothing.

    The list of days (one entry per calendar day) comes to the driver, so that bronze is read by partition. The days
    are noted as loaded only after they were replaced: a run that dies in between is simply repeated.
    """
    days = sorted(pending(wh, feed).collect(), key=lambda r: r["event_date"])
    if not days:
        return []
    filled = [(r["event_date"], r["snapshot_id"]) for r in days if r["linhas"]]
    emptied = [r["event_date"] for r in days if not r["linhas"]]
    wh.replace_days(feed.table, _checked(_chosen(wh, feed, filled), feed, settings), emptied)
    _note_loaded(wh, feed, [(r["event_date"], r["data_extracao"]) for r in days])
    return [r["event_date"] for r in days]


def _checked(records: DataFrame, feed: Feed, settings: Settings) -> DataFrame:
    """Typed rows; one that breaks a declared constraint stops the load before any day is replaced."""
    return enforced(feed.table, silver_rows(records, feed, settings), CONSTRAINTS[feed.table])


def _note_loaded(wh: Warehouse, feed: Feed, days: list[tuple[dt.date, dt.datetime]]) -> None:
    """Extraction time and counts of the days that were just replaced; only those days are read."""
    noted = wh.spark.createDataFrame(days, "event_date date, data_extracao timestamp_ntz")
    rows = wh.silver(feed.table).where(F.col("event_date").isin(*[day for day, _ in days]))
    _note(wh, feed, noted, rows)


def _note(wh: Warehouse, feed: Feed, noted: DataFrame, rows: DataFrame) -> None:
    valid = F.count_if("trafego_valido") if "trafego_valido" in rows.columns else F.lit(None).cast("bigint")
    counts = rows.groupBy("event_date").agg(F.count("*").alias("linhas"), valid.alias("validas"))
    wh.note("loaded", noted.join(counts, "event_date", "left").select(
        F.lit(feed.table).alias("tabela"), "event_date", "data_extracao", F.coalesce("linhas", F.lit(0)).alias("linhas"),
        "validas", F.localtimestamp().alias("executado_em")))


def rebuild_silver(wh: Warehouse, feed: Feed, settings: Settings) -> None:
    """Everything again from the newest snapshot of every day, e.g. after a rule changed.

    The old table counts until the new one is whole. A run that dies before the days are noted leaves days that look
    older than they are, and the next load replaces them once more.
    """
    newest = bronze.newest_snapshots(wh.snapshots().where(F.col("relatorio") == feed.name))
    wh.replace_all(feed.table, _checked(bronze.newest_rows(wh.bronze(feed), newest), feed, settings))
    _note(wh, feed, newest.select("event_date", "data_extracao"), wh.silver(feed.table))


def _chosen(wh: Warehouse, feed: Feed, days: list[tuple[dt.date, str]]) -> DataFrame:
    """Rows of the chosen (day, snapshot) folders: literal partition filters, then the exact pairs."""
    rows = wh.bronze(feed).where(
        F.col("event_date").isin(*[d for d, _ in days]) & F.col("snapshot_id").isin(*{s for _, s in days})
    )
    pairs = wh.spark.createDataFrame(days, "event_date date, snapshot_id string")
    return rows.join(pairs, ["event_date", "snapshot_id"], "left_semi")


def daily_load(wh: Warehouse, settings: Settings) -> dict[str, list[dt.date]]:
    """Silver refresh of all feeds; returns the days replaced per table."""
    return {feed.table: refresh_silver(wh, feed, settings) for feed in FEEDS.values()}


def wanted_ranges(wh: Warehouse, settings: Settings, today: dt.date, history: bool = False) -> DataFrame:
    """(relatorio, range_start, range_end): what to extract next, from the control and snapshot logs."""
    floors = wh.spark.createDataFrame([(f.name, _floor(f, today)) for f in FEEDS.values()], "relatorio string, floor date")
    return bronze.extraction_ranges(wh.control(), wh.snapshots(), floors, today, settings, history)


def _floor(feed: Feed, today: dt.date) -> dt.date:
    """First day a first run asks for."""
    return today - dt.timedelta(days=feed.min_history_days) if feed.min_history_days else feed.first_day


def land_delivered(
    wh: Warehouse, settings: Settings, inbox: str, today: dt.date, extracted_at: dt.datetime, history: bool = False,
) -> list[tuple[str, dt.date, dt.date]]:
    """Land what was delivered for the wanted ranges, ``<inbox>/<feed>/<start>_<end>``; returns the ranges landed.

    A range that was not delivered stays wanted: its window does not reach the control log, so the next one is wider.
    The ranges, a few per feed and month, come to the driver.
    """
    landed_ranges = []
    for row in sorted(wanted_ranges(wh, settings, today, history).collect()):
        report, start, end = row["relatorio"], row["range_start"], row["range_end"]
        folder = f"{inbox}/{report}/{start}_{end}"
        if wh.exists(folder):
            sid = f"{start}_{end}-{extracted_at:%Y%m%d%H%M%S}"
            land(wh, FEEDS[report], folder, extracted_at, "historico" if history else "incremental", sid, (start, end))
            landed_ranges.append((report, start, end))
    return landed_ranges


# ---- counts after a load -------------------------------------------------------------------------------------------

def silver_counts(s: Silver) -> DataFrame:
    """Rows, valid rows and days of each fact table, one scan per table."""
    tables = {
        "ga4_eventos": s.ga4_eventos, "ga4_paineis": s.ga4_paineis,
        "ga4_usuarios": s.ga4_usuarios, "ga4_paginas": s.ga4_paginas,
    }
    parts = []
    for name, df in tables.items():
        valid = F.count_if(F.col("trafego_valido")) if "trafego_valido" in df.columns else F.lit(None).cast("bigint")
        parts.append(df.agg(
            F.lit(name).alias("tabela"), F.count("*").alias("linhas"), valid.alias("validas"),
            F.count_distinct("event_date").alias("dias"),
        ))
    return reduce(DataFrame.unionByName, parts)


def gold_counts(s: Silver, views: tuple[str, ...] = (
    "vw_paineis_ranking", "vw_site_overview", "vw_paineis_sem_mapeamento", "vw_usuarios_ativos",
    "vw_paineis_acessos", "vw_paineis_url_sem_mapa",
)) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        VIEWS[v](s).agg(F.lit(v).alias("visao"), F.count("*").alias("linhas")) for v in views
    ])


def dimension_counts(s: Silver) -> DataFrame:
    """Active panels per type, aliases, and URL targets per origin."""
    return reduce(DataFrame.unionByName, [
        s.dim_painel.where("ativo").groupBy(F.col("tipo").alias("grupo")).agg(F.count("*").alias("linhas"))
        .select(F.lit("dim_painel").alias("tabela"), "grupo", "linhas"),
        s.dim_painel_alias.agg(F.count("*").alias("linhas"))
        .select(F.lit("dim_painel_alias").alias("tabela"), F.lit("").alias("grupo"), "linhas"),
        s.dim_painel_relatorio.groupBy(F.col("fonte").alias("grupo")).agg(F.count("*").alias("linhas"))
        .select(F.lit("dim_painel_relatorio").alias("tabela"), "grupo", "linhas"),
    ])
