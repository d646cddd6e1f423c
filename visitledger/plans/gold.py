"""Metric views over the silver tables.

Each view is a function of a :class:`Silver` bundle; ``start`` and ``end`` prune day partitions. Published column
names are part of the contract with reports and dashboards.

Additivity: event counts add everywhere. Sessions and users repeat on every event row, so they are read from the
session-start row only, and engagement seconds from the engagement row only. ``acessos`` of a panel adds across days;
``pessoas_7d``, ``pessoas_28d``, ``wau``, ``mau`` and every ``*_7d`` column never do: read the last day of a period.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ENGAGEMENT_EVENT, SESSION_EVENT, WINDOW_DAYS, Settings
from ..functions.traffic import valid_traffic
from ..operators import panels
from ..operators.rolling import rolling_sums
from ..sources.tables import Warehouse


@dataclass(frozen=True)
class Silver:
    ga4_eventos: DataFrame
    ga4_paineis: DataFrame
    ga4_usuarios: DataFrame
    ga4_paginas: DataFrame
    dim_painel: DataFrame
    dim_painel_alias: DataFrame
    dim_painel_relatorio: DataFrame
    settings: Settings
    #: Statistics of the loaded days (tabela, event_date, linhas, data_extracao); without them the facts are counted.
    days: DataFrame | None = None

    @classmethod
    def of(cls, wh: Warehouse, settings: Settings) -> "Silver":
        facts = [wh.silver(t) for t in ("ga4_eventos", "ga4_paineis", "ga4_usuarios", "ga4_paginas")]
        dims = [wh.dim(t) for t in ("dim_painel", "dim_painel_alias", "dim_painel_relatorio")]
        return cls(*facts, *dims, settings, wh.days())


def _between(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("event_date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("event_date") <= F.lit(end))
    return df


def _sum_if(cond: Column, col: str) -> Column:
    return F.sum(F.when(cond, F.col(col)))


# ---- site usage ----------------------------------------------------------------------------------------------------

def vw_sessoes(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row per segment; every metric comes from the event that carries it."""
    rows = _between(s.ga4_eventos, start, end).where(F.col("site") != s.settings.other_site)
    on_start = F.col("event_name") == SESSION_EVENT
    on_engagement = F.col("event_name") == ENGAGEMENT_EVENT
    return rows.groupBy(
        "event_date", "site", "hostname", "country", "region", "city", "device_category", "browser",
        "operating_system", "trafego_valido",
    ).agg(
        _sum_if(on_start, "sessions").alias("sessions"),
        _sum_if(on_start, "engaged_sessions").alias("engaged_sessions"),
        _sum_if(on_start, "active_users").alias("active_users"),
        F.coalesce(_sum_if(on_engagement, "user_engagement_seconds"), F.lit(0)).alias("user_engagement_seconds"),
    )


def vw_site_overview(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Valid traffic of all sites, straight from the events: one aggregation instead of two."""
    rows = _between(s.ga4_eventos, start, end).where((F.col("site") != s.settings.other_site) & F.col("trafego_valido"))
    on_start = F.col("event_name") == SESSION_EVENT
    on_engagement = F.col("event_name") == ENGAGEMENT_EVENT
    return rows.groupBy("event_date", "site", "device_category", "country", "region").agg(
        _sum_if(on_start, "active_users").alias("usuarios"),
        _sum_if(on_start, "sessions").alias("sessoes"),
        _sum_if(on_start, "engaged_sessions").alias("sessoes_engajadas"),
        F.coalesce(_sum_if(on_engagement, "user_engagement_seconds"), F.lit(0)).alias("tempo_engajamento_s"),
    )


def vw_institucional_eventos(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    rows = _between(s.ga4_eventos, start, end).where(
        (F.col("site") == s.settings.home_site.label) & F.col("trafego_valido")
    )
    return rows.groupBy("event_date", "event_name", "country", "region", "device_category").agg(
        F.sum("event_count").alias("eventos"), F.sum("active_users").alias("usuarios")
    )


def vw_qualidade_trafego(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Audit of the robot rule: sessions kept and discarded. Not a business metric."""
    rows = _between(s.ga4_eventos, start, end).where(F.col("site") != s.settings.other_site)
    on_start = F.col("event_name") == SESSION_EVENT
    return rows.groupBy("event_date", "site", "country", "region").agg(
        _sum_if(on_start & F.col("trafego_valido"), "sessions").alias("sessoes_validas"),
        _sum_if(on_start & ~F.col("trafego_valido"), "sessions").alias("sessoes_descartadas"),
    )


# ---- panels --------------------------------------------------------------------------------------------------------

def _panel_rows(s: Silver, start: dt.date | None, end: dt.date | None) -> DataFrame:
    return _between(s.ga4_paineis, start, end).where(F.col("site") == s.settings.panel_site.label)


def _page_rows(s: Silver, start: dt.date | None, end: dt.date | None) -> DataFrame:
    return _between(s.ga4_paginas, start, end).where(F.col("site") == s.settings.panel_site.label)


def vw_painel_normalizado(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Every panel event with its canonical panel, or NULL. The row keeps its own columns, so no id is needed."""
    return panels.resolve_names(_between(s.ga4_paineis, start, end), s.dim_painel, s.dim_painel_alias)


def vw_paineis_acessos(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Official panel ranking, by opened URL.

    Someone who opens the desktop and the mobile version, or two encodings of one URL, on one day counts twice.
    """
    rows = panels.with_target(_page_rows(s, start, end), s.dim_painel_relatorio, s.dim_painel)
    return rows.groupBy(
        "event_date", "painel", "ordem_menu", "tema", "hierarquia", "tipo", "versao"
    ).agg(
        F.sum("page_views").alias("aberturas"),
        F.sum("usuarios").alias("acessos"),
        F.sum("usuarios_7d").alias("pessoas_7d"),
        F.sum("usuarios_28d").alias("pessoas_28d"),
    )


def vw_paineis_url_sem_mapa(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Audit: opened targets nobody mapped. Unreadable URLs form one NULL group. Sort when reading."""
    rows = _page_rows(s, start, end).where(F.coalesce("alvo", F.lit("")) != s.settings.contact_page)
    return panels.unmapped_targets(rows, s.dim_painel_relatorio).groupBy("alvo").agg(
        F.min("event_date").alias("primeira_data"),
        F.max("event_date").alias("ultima_data"),
        F.sum("page_views").alias("aberturas"),
        F.min("page_location").alias("exemplo_url"),
    )


def vw_paineis_ranking(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Click ranking, an audit of the tags. The two click events fire together: never add them up."""
    known = panels.with_panel(_panel_rows(s, start, end), s.dim_painel, s.dim_painel_alias)
    mean = F.try_divide(F.sum("user_engagement_seconds"), F.sum("sessions").cast("decimal(19,0)"))
    return known.groupBy("event_date", "painel", "ordem_menu", "tema", "hierarquia", "event_name").agg(
        F.sum("event_count").alias("acessos"),
        F.sum("sessions").alias("sessoes"),
        F.sum("active_users").alias("usuarios"),
        F.sum("engaged_sessions").alias("sessoes_engajadas"),
        F.round(mean, 1).alias("tempo_medio_seg"),
    )


def vw_engajamento_dispositivo(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    known = panels.with_panel(_panel_rows(s, start, end), s.dim_painel, s.dim_painel_alias)
    return known.groupBy("event_date", "painel", "tema", "event_name", "device_category").agg(
        F.sum("sessions").alias("sessoes"),
        F.sum("active_users").alias("usuarios"),
        F.sum("engaged_sessions").alias("sessoes_engajadas"),
        F.sum("user_engagement_seconds").alias("tempo_engajamento_s"),
    )


def vw_paineis_sem_mapeamento(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Audit: delivered names without a panel. The not-set name is a tagging matter and left out. Sort when reading."""
    rows = _panel_rows(s, start, end).where(F.col("nome_painel_raw") != "(not set)")
    unknown = panels.unmatched_names(rows, s.dim_painel, s.dim_painel_alias)
    return unknown.groupBy("nome_painel_raw").agg(F.sum("event_count").alias("eventos"))


# ---- active users --------------------------------------------------------------------------------------------------

def windowed_segments(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Daily rows with 7- and 28-day sums and the validity of each window.

    A range of days is read with 27 days of lookback and cut afterwards: a day filter is not pushed below a window,
    and without the lookback the first days of the range would see shortened windows.
    """
    read_from = None if start is None else start - dt.timedelta(days=max(WINDOW_DAYS) - 1)
    rows = _between(s.ga4_usuarios, read_from, end).where(F.col("site") != s.settings.other_site)
    measures = ("sessions", "engaged_sessions", "user_engagement_seconds")
    named = {n: {f"{m}_{n}d": m for m in measures} for n in WINDOW_DAYS}
    rolled = rolling_sums(rows, ["hostname", "country", "device_category"], named)
    for n in WINDOW_DAYS:
        sessions, engaged = (F.col(f"{m}_{n}d") for m in measures[:2])
        rolled = rolled.withColumn(f"valid_{n}d", valid_traffic(sessions, engaged, s.settings.robots))
    return _between(rolled, start, None)


def vw_usuarios_ativos(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """DAU, WAU and MAU of valid traffic; each window is judged by its own sessions, not by the day's."""
    day, week, month = WINDOW_DAYS
    published = {
        "dau": ("dau", day), "wau": ("wau", week), "mau": ("mau", month),
        "sessoes": (f"sessions_{day}d", day), "sessoes_engajadas": (f"engaged_sessions_{day}d", day),
        "tempo_engajamento_s": (f"user_engagement_seconds_{day}d", day),
        "sessoes_7d": (f"sessions_{week}d", week), "sessoes_engajadas_7d": (f"engaged_sessions_{week}d", week),
        "tempo_engajamento_7d_s": (f"user_engagement_seconds_{week}d", week),
    }
    return windowed_segments(s, start, end).groupBy("event_date", "site", "country", "device_category").agg(
        *[_sum_if(F.col(f"valid_{n}d"), column).alias(name) for name, (column, n) in published.items()])


VIEWS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        vw_sessoes, vw_site_overview, vw_institucional_eventos, vw_qualidade_trafego, vw_painel_normalizado,
        vw_paineis_acessos, vw_paineis_url_sem_mapa, vw_paineis_ranking, vw_engajamento_dispositivo,
        vw_paineis_sem_mapeamento, vw_usuarios_ativos,
    )
}


def register_views(s: Silver, start: dt.date | None = None, end: dt.date | None = None) -> list[str]:
    """Make every view available to ``spark.sql`` under its published name."""
    for name, view in VIEWS.items():
        view(s, start, end).createOrReplaceTempView(name)
    return list(VIEWS)
