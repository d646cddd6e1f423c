"""Calendar, lookups, measures and the dashboard visuals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates
from ..operators.ranking import keep_top_members
from ..plans import gold, star
from ..plans.measures import MEASURES
from . import dataset as d
from .oracle import big
from .registry import register, registered

_MONTH = "CASE month(event_date) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.MONTHS_SHORT, 1)) + " END"
_DAY = "CASE dayofweek(event_date) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.DAYS)) + " END"
_CALENDAR = f"""CAST(year(event_date) AS INT) AS ano, CAST(month(event_date) AS INT) AS numero_mes, {_MONTH} AS mes,
    {_MONTH} || '/' || year(event_date) AS mes_e_ano, 'T' || quarter(event_date) AS trimestre,
    CAST(dayofweek(event_date) + 1 AS INT) AS dia_da_semana, {_DAY} AS nome_do_dia"""


@registered("calendar", f"""WITH days AS (SELECT CAST(unnest(generate_series(
        date_trunc('year', (SELECT min(o_orderdate) FROM orders)),
        date_trunc('year', (SELECT max(o_orderdate) FROM orders)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS event_date),
      n AS (SELECT CAST(o_orderdate AS DATE) AS event_date, count(*) AS orders FROM orders GROUP BY ALL)
    SELECT event_date, {_CALENDAR}, COALESCE(orders, 0) AS orders FROM days LEFT JOIN n USING (event_date)""")
def calendar(spark, sf_dir):
    """Whole years around all order dates, with the orders of each day."""
    per_day = d.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("event_date")).agg(
        F.count("*").alias("orders")
    )
    span = per_day.agg(F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))
    return star.calendar(span).join(per_day, "event_date", "left").fillna(0, ["orders"])


@registered("calendar_rollup", """SELECT CAST(year(day) AS INT) AS ano, CAST(quarter(day) AS INT) AS trimestre, CAST(month(day) AS INT) AS mes,
      CAST(day(day) AS INT) AS dia, count(*) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders)
    GROUP BY ROLLUP (year(day), quarter(day), month(day), day(day))""")
def calendar_rollup(spark, sf_dir):
    """Year, quarter, month, day drill-down; days are counted once and then rolled up."""
    per_day = d.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n")
    )
    return per_day.select(
        F.year("day").alias("ano"), F.quarter("day").alias("trimestre"), F.month("day").alias("mes"),
        F.dayofmonth("day").alias("dia"), "n",
    ).rollup("ano", "trimestre", "mes", "dia").agg(F.sum("n").alias("orders"))


# ---- one query per measure, by day (maintenance measures have no day) ----------------------------------------------

def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _div(n: str, den: str) -> str:
    return f"COALESCE({_dbl(n)} / NULLIF({_dbl(den)}, 0), 0.0)"


_SEC_VALID = f"{_dbl(big('sum(cents) FILTER (WHERE trafego_valido)'))} / 100"
_SEC_MOBILE = f"{_dbl(big(chr(39).join(['sum(cents) FILTER (WHERE trafego_valido AND device_category = ', 'mobile', ')'])))} / 100"
_SES_VALID = "sum(sessions) FILTER (WHERE trafego_valido)"
_MOBILE = "sum(sessoes) FILTER (WHERE device_category = 'mobile')"
_KEPT, _DROPPED = "sum(sessoes_validas)", "sum(sessoes_descartadas)"
_GROSS = f"(COALESCE({_KEPT}, 0) + COALESCE({_DROPPED}, 0))"

_RANK, _DEV, _SES = "vw_paineis_ranking", "vw_engajamento_dispositivo", "vw_sessoes"
_QUA, _OVE, _HOME, _UNM = "vw_qualidade_trafego", "vw_site_overview", "vw_institucional_eventos", "vw_paineis_sem_mapeamento"

MEASURE_SQL: dict[str, tuple[str, str]] = {
    "total_acessos": (_RANK, big("sum(acessos)")),
    "usuarios_unicos": (_RANK, big("sum(usuarios)")),
    "sessoes": (_RANK, big("sum(sessoes)")),
    "sessoes_engajadas": (_RANK, big("sum(sessoes_engajadas)")),
    "tempo_medio_min": (_RANK, f"COALESCE({_dbl(big('sum(tenths)'))} / 10 / 60, 0.0)"),
    "taxa_engajamento": (_RANK, _div("sum(sessoes_engajadas)", "sum(sessoes)")),
    "acessos_mobile": (_DEV, big(_MOBILE)),
    "acessos_desktop": (_DEV, big("sum(sessoes) FILTER (WHERE device_category = 'desktop')")),
    "total_acessos_dispositivo": (_DEV, big("sum(sessoes)")),
    "pct_mobile": (_DEV, _div(_MOBILE, "sum(sessoes)")),
    "tempo_engaj_mobile_min": (_SES, _div(_SEC_MOBILE, f"{_SES_VALID} * 60")),
    "total_sessoes_site": (_SES, big("sum(sessions)")),
    "sessoes_validas": (_SES, big(_SES_VALID)),
    "usuarios_ativos": (_SES, big("sum(active_users)")),
    "sessoes_engajadas_site": (_SES, big("sum(engaged_sessions)")),
    "tempo_total_engaj_min": (_SES, f"COALESCE({_SEC_VALID} / 60, 0.0)"),
    "sessoes_validas_total": (_QUA, big(_KEPT)),
    "sessoes_descartadas": (_QUA, big(_DROPPED)),
    "total_sessoes_bruto": (_QUA, big(_GROSS)),
    "pct_trafego_real": (_QUA, _div(_KEPT, _GROSS)),
    "pct_bots": (_QUA, _div(_DROPPED, _GROSS)),
    "total_usuarios": (_OVE, big("sum(usuarios)")),
    "total_sessoes": (_OVE, big("sum(sessoes)")),
    "total_sessoes_engajadas": (_OVE, big("sum(sessoes_engajadas)")),
    "taxa_engaj_site": (_OVE, _div("sum(sessoes_engajadas)", "sum(sessoes)")),
    "tempo_engaj_medio_min": (_SES, _div(_SEC_VALID, f"{_SES_VALID} * 60")),
    "eventos_institucional": (_HOME, big("sum(eventos)")),
    "usuarios_institucional": (_HOME, big("sum(usuarios)")),
    "pageviews": (_HOME, big("sum(eventos) FILTER (WHERE event_name = 'page_view')")),
    "eventos_por_usuario": (_HOME, _div("sum(eventos)", "sum(usuarios)")),
    "paineis_sem_mapeamento": (_UNM, "count(*)"),
    "eventos_nao_mapeados": (_UNM, big("sum(eventos)")),
    "acessos_abertos": (_RANK, big("sum(acessos) FILTER (WHERE event_name = 'painel_acessado')")),
    "tempo_por_sessao_min": (_DEV, _div(f"{_dbl(big('sum(cents)'))} / 100", "sum(sessoes) * 60")),
    "tempo_mobile_por_sessao_min": (
        _SES, _div(_SEC_MOBILE, "sum(sessions) FILTER (WHERE trafego_valido AND device_category = 'mobile') * 60")),
}


def _measure(name: str):
    by = [] if MEASURE_SQL[name][0] == _UNM else ["event_date"]
    return lambda spark, sf_dir: star.query(d.silver(spark, sf_dir), [name], by)


for _name, (_from, _sql) in MEASURE_SQL.items():
    if _from == _UNM:
        register(f"measure_{_name}", _measure(_name), f"SELECT {_sql} AS {_name} FROM {_from}")
    else:
        register(f"measure_{_name}", _measure(_name), f"SELECT event_date, {_sql} AS {_name} FROM {_from} GROUP BY event_date")


def _m(*names: str) -> str:
    return ", ".join(f"{MEASURE_SQL[n][1]} AS {n}" for n in names)


# ---- dashboard pages -----------------------------------------------------------------------------------------------

@registered("card_overview", f"""SELECT * FROM (SELECT site, {_m("total_sessoes", "taxa_engaj_site")} FROM vw_site_overview GROUP BY site)
    FULL JOIN (SELECT site, {_m("sessoes_validas", "tempo_engaj_medio_min")} FROM vw_sessoes GROUP BY site) USING (site)""")
def card_overview(spark, sf_dir):
    """Measures of two views on one card, per site."""
    return star.query(
        d.silver(spark, sf_dir), ["total_sessoes", "taxa_engaj_site", "sessoes_validas", "tempo_engaj_medio_min"], ["site"]
    )


@registered("card_panels", f"SELECT {_m('total_acessos', 'usuarios_unicos', 'taxa_engajamento', 'tempo_medio_min')} FROM vw_paineis_ranking")
def card_panels(spark, sf_dir):
    return star.query(
        d.silver(spark, sf_dir), ["total_acessos", "usuarios_unicos", "taxa_engajamento", "tempo_medio_min"]
    )


@registered("card_devices", f"""SELECT * FROM (SELECT {_m('pct_mobile', 'acessos_mobile', 'acessos_desktop')} FROM vw_engajamento_dispositivo),
    (SELECT {_m('tempo_engaj_mobile_min')} FROM vw_sessoes)""")
def card_devices(spark, sf_dir):
    return star.query(
        d.silver(spark, sf_dir), ["pct_mobile", "acessos_mobile", "acessos_desktop", "tempo_engaj_mobile_min"]
    )


@registered("card_audience", f"SELECT {_m('sessoes_validas', 'usuarios_ativos', 'sessoes_engajadas_site')} FROM vw_sessoes")
def card_audience(spark, sf_dir):
    return star.query(d.silver(spark, sf_dir), ["sessoes_validas", "usuarios_ativos", "sessoes_engajadas_site"])


@registered("card_home_site", f"SELECT {_m('pageviews', 'usuarios_institucional', 'eventos_por_usuario')} FROM vw_institucional_eventos")
def card_home_site(spark, sf_dir):
    return star.query(d.silver(spark, sf_dir), ["pageviews", "usuarios_institucional", "eventos_por_usuario"])


@registered("bars_by_system", f"""SELECT operating_system, {_m('sessoes_validas')} FROM vw_sessoes
    WHERE country NOT IN ('AFRICA') AND event_date >= DATE '2024-01-10' AND site IN ('Institucional') GROUP BY operating_system""")
def bars_by_system(spark, sf_dir):
    """Bars under the page's slicers: an excluded member, a date lower bound, a site."""
    return star.by_category(
        d.silver(spark, sf_dir), "sessoes_validas", "operating_system",
        where=[star.exclude("country", "AFRICA"), star.from_day(dt.date(2024, 1, 10)), star.members("site", "Institucional")],
    )


@registered("bars_by_state", f"""SELECT estado, {_m('sessoes_validas')} FROM vw_sessoes LEFT JOIN dim_regiao USING (region)
    GROUP BY estado""")
def bars_by_state(spark, sf_dir):
    """State through the region lookup; unmatched regions form the blank member."""
    return star.by_category(
        d.silver(spark, sf_dir), "sessoes_validas", "estado", regions=d.region_dimension(spark, sf_dir)
    )


@registered("donut_home_devices", f"SELECT device_category, {_m('usuarios_institucional')} FROM vw_institucional_eventos GROUP BY ALL")
def donut_home_devices(spark, sf_dir):
    return star.by_category(d.silver(spark, sf_dir), "usuarios_institucional", "device_category")


@registered("series_site_days", f"""SELECT CAST(year(event_date) AS INT) AS ano, {_MONTH} AS mes, event_date, site, {_m('sessoes_validas')}
    FROM vw_sessoes GROUP BY ALL""")
def series_site_days(spark, sf_dir):
    return star.query(d.silver(spark, sf_dir), ["sessoes_validas"], ["ano", "mes", "event_date", "site"])


@registered("series_panel_days", f"""SELECT mes_e_ano, nome_do_dia, painel, {_m('total_acessos')} FROM
    (SELECT *, {_CALENDAR} FROM vw_paineis_ranking) WHERE tema IN ('ECONOMY', 'PROMO') GROUP BY mes_e_ano, nome_do_dia, painel""")
def series_panel_days(spark, sf_dir):
    """Panel series under the theme slicer."""
    return star.query(
        d.silver(spark, sf_dir), ["total_acessos"], ["mes_e_ano", "nome_do_dia", "painel"],
        where=[star.members("tema", "ECONOMY", "PROMO")],
    )


_MATRIX = ("total_acessos", "usuarios_unicos", "sessoes_engajadas", "taxa_engajamento", "tempo_medio_min")


@registered("matrix_panels", f"SELECT painel, {_m(*_MATRIX)} FROM vw_paineis_ranking GROUP BY painel")
def matrix_panels(spark, sf_dir):
    return star.query(d.silver(spark, sf_dir), list(_MATRIX), ["painel"])


@registered("matrix_totals", f"""SELECT CAST(grouping_id(tema, painel) AS BIGINT) AS level, tema, painel, {_m(*_MATRIX)}
    FROM vw_paineis_ranking GROUP BY ROLLUP (tema, painel)""")
def matrix_totals(spark, sf_dir):
    """Subtotals and the total row, with ratios of totals."""
    return star.query(d.silver(spark, sf_dir), list(_MATRIX), ["tema", "painel"], totals=True)


@registered("matrix_panel_device", """SELECT painel, CAST(sum(sessoes) FILTER (WHERE device_category = 'desktop') AS BIGINT) AS desktop,
    CAST(sum(sessoes) FILTER (WHERE device_category = 'mobile') AS BIGINT) AS mobile,
    CAST(sum(sessoes) FILTER (WHERE device_category = '(not set)') AS BIGINT) AS "(not set)"
    FROM vw_engajamento_dispositivo GROUP BY painel""")
def matrix_panel_device(spark, sf_dir):
    return star.device_matrix(d.silver(spark, sf_dir), ["desktop", "mobile", "(not set)"])


@registered("stacked_devices", """SELECT painel, acessos_desktop, acessos_mobile,
      CAST(COALESCE(acessos_desktop, 0) AS DOUBLE) / NULLIF(COALESCE(acessos_desktop, 0) + COALESCE(acessos_mobile, 0), 0) AS acessos_desktop_share,
      CAST(COALESCE(acessos_mobile, 0) AS DOUBLE) / NULLIF(COALESCE(acessos_desktop, 0) + COALESCE(acessos_mobile, 0), 0) AS acessos_mobile_share
    FROM (SELECT painel, CAST(sum(sessoes) FILTER (WHERE device_category = 'desktop') AS BIGINT) AS acessos_desktop,
            CAST(sum(sessoes) FILTER (WHERE device_category = 'mobile') AS BIGINT) AS acessos_mobile
          FROM vw_engajamento_dispositivo GROUP BY painel)""")
def stacked_devices(spark, sf_dir):
    both = star.query(d.silver(spark, sf_dir), ["acessos_desktop", "acessos_mobile"], ["painel"])
    return star.shares_of(both, "acessos_desktop", "acessos_mobile")


@registered("scatter_panels", f"SELECT painel, {_m('total_acessos', 'taxa_engajamento')} FROM vw_paineis_ranking GROUP BY painel")
def scatter_panels(spark, sf_dir):
    return star.query(d.silver(spark, sf_dir), ["total_acessos", "taxa_engajamento"], ["painel"])


@registered("map_countries", f"""SELECT country, min(uf) AS uf, {_m('sessoes_validas', 'usuarios_ativos')}
    FROM vw_sessoes LEFT JOIN dim_regiao USING (region) GROUP BY country""")
def map_countries(spark, sf_dir):
    return star.map_points(d.silver(spark, sf_dir), d.region_dimension(spark, sf_dir))


@registered("top10_members", """WITH best AS (SELECT painel FROM vw_paineis_ranking GROUP BY painel ORDER BY sum(acessos) DESC, painel LIMIT 10)
    SELECT event_date, painel, CAST(sum(acessos) AS BIGINT) AS acessos FROM vw_paineis_ranking
    WHERE painel IN (SELECT painel FROM best) GROUP BY ALL""")
def top10_members(spark, sf_dir):
    """Days of the ten panels with most accesses."""
    facts = gold.vw_paineis_ranking(d.silver(spark, sf_dir))
    days = facts.groupBy("event_date", "painel").agg(F.sum("acessos").alias("acessos"))
    return keep_top_members(days, "painel", F.sum("acessos"), 10)


@registered("region_sessions", f"""SELECT event_date, region, estado, uf, pais, {_m('sessoes_validas', 'total_sessoes_site')}
    FROM vw_sessoes LEFT JOIN dim_regiao USING (region) GROUP BY ALL""")
def region_sessions(spark, sf_dir):
    return star.query(
        d.silver(spark, sf_dir), ["sessoes_validas", "total_sessoes_site"], ["event_date", "region", "estado", "uf", "pais"],
        regions=d.region_dimension(spark, sf_dir),
    )


assert set(MEASURE_SQL) == {n for n in MEASURES if not n.startswith("_")}
