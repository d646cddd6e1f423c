"""The metric views and the steps below them."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rolling import rolling_sums
from ..operators.segments import flag_by_join
from ..plans import gold
from . import dataset as d
from .oracle import money
from .registry import register, registered

_SEGMENT = "event_date, hostname, site, country, region, city, device_category, browser, operating_system"


def _view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.VIEWS[name](d.silver(spark, sf_dir))


register("session_base", partial(_view, "vw_sessoes"),
         f"SELECT * EXCLUDE (cents), {money('cents', 'user_engagement_seconds')} FROM vw_sessoes")
register("site_overview", partial(_view, "vw_site_overview"),
         f"SELECT * EXCLUDE (cents), {money('cents', 'tempo_engajamento_s')} FROM vw_site_overview")
register("site_events", partial(_view, "vw_institucional_eventos"), "SELECT * FROM vw_institucional_eventos")
register("traffic_quality", partial(_view, "vw_qualidade_trafego"), "SELECT * FROM vw_qualidade_trafego")
register("panel_opens", partial(_view, "vw_paineis_acessos"), "SELECT * FROM vw_paineis_acessos")
register("panel_ranking", partial(_view, "vw_paineis_ranking"),
         "SELECT * EXCLUDE (tenths), CAST(tenths AS DOUBLE) / 10 AS tempo_medio_seg FROM vw_paineis_ranking")
register("panel_by_device", partial(_view, "vw_engajamento_dispositivo"),
         f"SELECT * EXCLUDE (cents), {money('cents', 'tempo_engajamento_s')} FROM vw_engajamento_dispositivo")
register("unmapped_panels", partial(_view, "vw_paineis_sem_mapeamento"), "SELECT * FROM vw_paineis_sem_mapeamento")
register("unmapped_targets", partial(_view, "vw_paineis_url_sem_mapa"), "SELECT * FROM vw_paineis_url_sem_mapa")
register("active_users", partial(_view, "vw_usuarios_ativos"),
         f"""SELECT * EXCLUDE (cents, cents_7d), {money('cents', 'tempo_engajamento_s')},
             {money('cents_7d', 'tempo_engajamento_7d_s')} FROM vw_usuarios_ativos""")


@registered("panel_resolved", """SELECT event_date, hostname, site, country, region, city, device_category, event_name,
    nome_painel_raw, painel, event_count FROM named_panels""")
def panel_resolved(spark, sf_dir):
    return _view("vw_painel_normalizado", spark, sf_dir).select(
        "event_date", "hostname", "site", "country", "region", "city", "device_category", "event_name",
        "nome_painel_raw", "painel", "event_count",
    )


_FLAGGED = f"""SELECT {_SEGMENT}, event_name, event_count, sessions, engaged_sessions, active_users,
    {money('cents', 'user_engagement_seconds')}, trafego_valido FROM eventos"""


@registered("segment_validity", _FLAGGED)
def segment_validity(spark, sf_dir):
    """Validity over rows just aggregated to segment and event: one window."""
    return d.site_feed(spark, sf_dir).drop("data_extracao")


@registered("segment_validity_joined", _FLAGGED)
def segment_validity_joined(spark, sf_dir):
    """The same flags for rows of unknown multiplicity: aggregate and join back."""
    rows = d.site_feed(spark, sf_dir).drop("data_extracao", "trafego_valido")
    return flag_by_join(rows, d.SETTINGS)


@registered("users_feed", f"SELECT * EXCLUDE (cents), {money('cents', 'user_engagement_seconds')} FROM usuarios")
def users_feed(spark, sf_dir):
    return d.user_feed(spark, sf_dir).drop("data_extracao")


@registered("panel_feed", f"SELECT * EXCLUDE (cents), {money('cents', 'user_engagement_seconds')} FROM paineis")
def panel_feed(spark, sf_dir):
    return d.panel_feed(spark, sf_dir).drop("data_extracao")


@registered("pages_feed", "SELECT * FROM paginas")
def pages_feed(spark, sf_dir):
    return d.page_feed(spark, sf_dir).drop("data_extracao")


@registered("rolling_sums", """
    SELECT o_orderstatus, event_date, n, CAST(sum(n) OVER w7 AS BIGINT) AS n_7d, CAST(sum(cents) OVER w7 AS BIGINT) AS cents_7d,
           CAST(sum(n) OVER w28 AS BIGINT) AS n_28d
    FROM (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS event_date, count(*) AS n,
                 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY ALL)
    WINDOW w7 AS (PARTITION BY o_orderstatus ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
           w28 AS (PARTITION BY o_orderstatus ORDER BY event_date RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW)""")
def rolling_order_sums(spark, sf_dir):
    """Seven years of days with gaps: RANGE frames, not ROWS."""
    daily = d.table(spark, sf_dir, "orders").groupBy(
        "o_orderstatus", F.to_date("o_orderdate").alias("event_date")
    ).agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    return rolling_sums(daily, ["o_orderstatus"], {7: {"n_7d": "n", "cents_7d": "cents"}, 28: {"n_28d": "n"}}).drop("cents")


_WINDOWS = [(f"{name}_{n}d", value, n) for n in (1, 7, 28) for name, value in (
    ("sessions", "sessions"), ("engaged_sessions", "engaged"), ("valid", "valid"))]


@registered("window_validity", f"""SELECT event_date, hostname, country, device_category, {', '.join(
    f"any_value({value}) FILTER (WHERE n = {n}) AS {name}" for name, value, n in _WINDOWS)} FROM recent_days GROUP BY ALL""")
def window_validity(spark, sf_dir):
    return gold.windowed_segments(d.silver(spark, sf_dir)).select(
        "event_date", "hostname", "country", "device_category", *[name for name, _, _ in _WINDOWS])


@registered("active_users_of_range", f"""SELECT * EXCLUDE (cents, cents_7d), {money('cents', 'tempo_engajamento_s')},
    {money('cents_7d', 'tempo_engajamento_7d_s')} FROM vw_usuarios_ativos
    WHERE event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28'""")
def active_users_of_range(spark, sf_dir):
    """A week of the view, with the lookback its 28-day window needs; earlier days are not read."""
    week = d.Span(dt.date(2024, 1, 22), dt.date(2024, 1, 28))
    return gold.vw_usuarios_ativos(d.silver(spark, sf_dir, week.reaching_back(d.LOOKBACK)), *week)


@registered("views_by_name", """SELECT site, CAST(sum(sessoes) AS BIGINT) AS sessoes FROM vw_site_overview GROUP BY site""")
def views_by_name(spark, sf_dir):
    """The views under their published names, read with plain SQL."""
    gold.register_views(d.silver(spark, sf_dir))
    return spark.sql("SELECT site, sum(sessoes) AS sessoes FROM vw_site_overview GROUP BY site")
