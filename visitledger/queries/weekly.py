"""The weekly report's figures for the week that ends on Sunday 28 January 2024."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import Week, week_start
from ..operators.ranking import period_change, share_of_total
from ..plans import gold, weekly
from . import dataset as d
from .oracle import big
from .registry import registered

SUNDAY = dt.date(2024, 1, 28)

_WEEKS = """(SELECT DATE '2024-01-28' AS week_end UNION ALL SELECT DATE '2024-01-21')"""
_SITES = "(SELECT 'Dados' AS site UNION ALL SELECT 'Institucional')"
_KPIS = f"""SELECT s.site, week_end,
      {big("COALESCE(sum(wau) FILTER (WHERE event_date = week_end), 0)")} AS wau,
      {big("COALESCE(sum(mau) FILTER (WHERE event_date = week_end), 0)")} AS mau,
      {big("COALESCE(sum(sessoes_7d) FILTER (WHERE event_date = week_end), 0)")} AS sessoes,
      {big("COALESCE(sum(sessoes_engajadas_7d) FILTER (WHERE event_date = week_end), 0)")} AS engajadas,
      CAST({big("COALESCE(sum(cents_7d) FILTER (WHERE event_date = week_end), 0)")} AS DOUBLE) / 100 AS tempo_s,
      {big("COALESCE(sum(dau), 0)")} AS dau_total
    FROM {_SITES} s CROSS JOIN {_WEEKS} LEFT JOIN vw_usuarios_ativos u ON u.site = s.site AND event_date BETWEEN week_end - 6 AND week_end
    GROUP BY s.site, week_end"""
_SITE_KPIS = f"""SELECT site, week_end, wau, mau, sessoes, engajadas, sessoes / 7 AS sessoes_dia, dau_total / 7 AS dau_medio,
      CASE WHEN sessoes = 0 THEN 0.0 ELSE tempo_s / sessoes END AS tempo_sessao,
      CASE WHEN wau = 0 THEN 0.0 ELSE sessoes / wau END AS visitas_usuario,
      engajadas / NULLIF(sessoes, 0) AS engajadas_pct, (dau_total / 7) / NULLIF(wau, 0) AS frequencia FROM ({_KPIS})"""
_CHANGE = f"""SELECT site, wau, wau_previous, CAST(wau - wau_previous AS DOUBLE) / NULLIF(wau_previous, 0) AS wau_change
    FROM (SELECT site, {big("COALESCE(sum(wau) FILTER (WHERE week_end = DATE '2024-01-28'), 0)")} AS wau,
            {big("COALESCE(sum(wau) FILTER (WHERE week_end = DATE '2024-01-21'), 0)")} AS wau_previous FROM ({_KPIS}) GROUP BY site)"""
_PANELS = f"""SELECT painel, tema, {big("COALESCE(sum(acessos), 0)")} AS acessos,
      {big("COALESCE(sum(pessoas_7d) FILTER (WHERE event_date = DATE '2024-01-28'), 0)")} AS pessoas
    FROM vw_paineis_acessos WHERE event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' AND tipo = 'painel'
    GROUP BY painel, tema HAVING sum(acessos) > 0"""
_DAYS = f"""SELECT event_date, COALESCE(dau, 0) AS dau FROM
      (SELECT CAST(unnest(generate_series(DATE '2024-01-22', DATE '2024-01-28', INTERVAL 1 DAY)) AS DATE) AS event_date)
      LEFT JOIN (SELECT event_date, {big("sum(dau)")} AS dau FROM vw_usuarios_ativos WHERE site = 'Dados' GROUP BY ALL) USING (event_date)"""
_COUNTRIES = f"""SELECT country, {big("sum(wau)")} AS wau FROM vw_usuarios_ativos WHERE event_date = DATE '2024-01-28'
    GROUP BY country HAVING COALESCE(sum(wau), 0) > 0 ORDER BY 2 DESC, country LIMIT 5"""
_STATES = f"""SELECT CASE WHEN starts_with(region, 'State of ') THEN substr(region, 10) ELSE region END AS state, {big("sum(sessoes)")} AS sessoes
    FROM vw_site_overview WHERE country = 'ASIA' AND event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' AND region <> '(not set)'
    GROUP BY region HAVING COALESCE(sum(sessoes), 0) > 0 ORDER BY 2 DESC, region LIMIT 5"""
_DEVICES = f"""SELECT CASE device_category WHEN 'desktop' THEN 'Computador' WHEN 'mobile' THEN 'Celular' WHEN '(not set)' THEN 'Outro' ELSE device_category END AS device,
      wau, wau / {big("sum(wau) OVER ()")} AS share FROM (SELECT device_category, {big("sum(wau)")} AS wau FROM vw_usuarios_ativos
      WHERE site = 'Dados' AND event_date = DATE '2024-01-28' GROUP BY ALL HAVING COALESCE(sum(wau), 0) > 0)"""
_THEME = f"""SELECT tema, acessos, acessos / total AS share FROM (
      SELECT tema, {big("sum(acessos)")} AS acessos, {big("sum(sum(acessos)) OVER ()")} AS total, min(place) AS place
      FROM (SELECT *, row_number() OVER (ORDER BY acessos DESC, pessoas DESC, painel) AS place FROM ({_PANELS})) GROUP BY tema)
    ORDER BY acessos DESC, place LIMIT 1"""


#: Both weeks and what their rolling sums need.
_SPAN = d.Span(Week.of(SUNDAY).earlier().monday, SUNDAY).reaching_back(d.LOOKBACK)


def _silver(spark, sf_dir):
    return d.silver(spark, sf_dir, _SPAN)


@registered("weekly_site_kpis", _SITE_KPIS)
def weekly_site_kpis(spark, sf_dir):
    return weekly.site_kpis(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_change", f"""SELECT *, CASE WHEN wau_change IS NULL THEN 'sem semana anterior para comparar'
      WHEN abs(wau_change) < 0.03 THEN 'estável vs. semana anterior' ELSE (CASE WHEN wau_change > 0 THEN 'cresceu ' ELSE 'caiu ' END)
        || CAST(round_even(abs(wau_change) * 100, 0) AS BIGINT) || '% vs. semana anterior' END AS phrase,
      CASE WHEN wau_change IS NULL THEN 'new' WHEN abs(wau_change) < 0.005 THEN 'flat' WHEN wau_change > 0 THEN 'up' ELSE 'dn' END AS arrow
    FROM ({_CHANGE})""")
def weekly_change(spark, sf_dir):
    return weekly.site_change(weekly.site_kpis(_silver(spark, sf_dir), SUNDAY), SUNDAY)


_PART = """CASE WHEN abs({v}) >= 0.1 THEN 'o {s} ' || (CASE WHEN {v} > 0 THEN 'ganhou ' ELSE 'perdeu ' END)
      || CAST(round_even(abs({v}) * 100, 0) AS BIGINT) || '% de usuários' END"""


@registered("weekly_headline", f"""SELECT panel_change, home_change, CASE WHEN said <> '' THEN 'Esta semana, ' || said || ' frente à semana anterior.'
      ELSE 'Semana estável nos dois portais — sem grandes variações de público frente à anterior.' END AS headline
    FROM (SELECT *, concat_ws(' e ', {_PART.format(v='panel_change', s='Dados')}, {_PART.format(v='home_change', s='Institucional')}) AS said
          FROM (SELECT max(wau_change) FILTER (WHERE site = 'Dados') AS panel_change,
                  max(wau_change) FILTER (WHERE site = 'Institucional') AS home_change FROM ({_CHANGE})))""")
def weekly_headline(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    return weekly.week_headline(weekly.site_change(weekly.site_kpis(silver, SUNDAY), SUNDAY), silver)


@registered("weekly_daily_users", _DAYS)
def weekly_daily_users(spark, sf_dir):
    return weekly.daily_users(_silver(spark, sf_dir), "Dados", SUNDAY)


@registered("weekly_top_countries", _COUNTRIES)
def weekly_top_countries(spark, sf_dir):
    return weekly.top_countries(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_top_states", _STATES)
def weekly_top_states(spark, sf_dir):
    return weekly.top_states(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_devices", _DEVICES)
def weekly_devices(spark, sf_dir):
    return weekly.devices(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_panels", _PANELS)
def weekly_panels(spark, sf_dir):
    return weekly.top_panels(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_devices_top3", f"SELECT * FROM ({_DEVICES}) ORDER BY wau DESC, device LIMIT 3")
def weekly_devices_top3(spark, sf_dir):
    return weekly.devices(_silver(spark, sf_dir), SUNDAY, 3)


@registered("weekly_panels_top3", f"SELECT * FROM ({_PANELS}) ORDER BY acessos DESC, pessoas DESC, painel LIMIT 3")
def weekly_panels_top3(spark, sf_dir):
    return weekly.top_panels(_silver(spark, sf_dir), SUNDAY, 3)


@registered("weekly_panel_bars", f"""SELECT painel, tema, acessos, pessoas, CAST(row_number() OVER w AS INT) AS position,
      CAST(greatest(2, round_even(100.0 * (acessos / max(acessos) OVER ()), 0)) AS INT) AS width_pct
    FROM (SELECT * FROM ({_PANELS}) ORDER BY acessos DESC, pessoas DESC, painel LIMIT 6)
    WINDOW w AS (ORDER BY acessos DESC, pessoas DESC, painel)""")
def weekly_panel_bars(spark, sf_dir):
    return weekly.panel_bars(_silver(spark, sf_dir), SUNDAY)


@registered("weekly_top_theme", _THEME)
def weekly_top_theme(spark, sf_dir):
    return weekly.top_theme(_silver(spark, sf_dir), SUNDAY)


_LONG = " UNION ALL ".join(
    f"SELECT 'site' AS section, site AS member, week_end, '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM kpi_rows"
    for k in ("wau", "mau", "sessoes", "engajadas", "sessoes_dia", "dau_medio", "tempo_sessao", "visitas_usuario")
)


def _listing(section: str, member: str, kpi: str, source: str) -> str:
    return (f" UNION ALL SELECT '{section}', {member}, DATE '2024-01-28', '{kpi}', CAST({kpi} AS DOUBLE) FROM ({source})")


@registered("weekly_dataset", f"""WITH kpi_rows AS ({_SITE_KPIS}) {_LONG}
    {_listing('day', 'CAST(event_date AS VARCHAR)', 'dau', _DAYS)} {_listing('country', 'country', 'wau', _COUNTRIES)}
    {_listing('state', 'state', 'sessoes', _STATES)} {_listing('device', 'device', 'wau', _DEVICES)}
    {_listing('panel', 'painel', 'acessos', _PANELS)} {_listing('panel', 'painel', 'pessoas', _PANELS)}
    {_listing('theme', 'tema', 'share', _THEME)}""")
def weekly_dataset(spark, sf_dir):
    return weekly.weekly_dataset(_silver(spark, sf_dir), SUNDAY)


_ABSENT = """SELECT section, member, week_end, kpi, value FROM (VALUES ('Dados'), ('Institucional')) AS s(member),
      (VALUES (DATE '2023-12-24'), (DATE '2023-12-31')) AS w(week_end),
      (VALUES ('wau'), ('mau'), ('sessoes'), ('engajadas'), ('sessoes_dia'), ('dau_medio'), ('tempo_sessao'), ('visitas_usuario')) AS k(kpi),
      (VALUES ('site', CAST(0 AS DOUBLE))) AS z(section, value)"""


@registered("weekly_dataset_absent_week", f"""{_ABSENT} UNION ALL SELECT 'day', CAST(event_date AS VARCHAR), DATE '2023-12-31', 'dau', CAST(0 AS DOUBLE)
    FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2023-12-31', INTERVAL 1 DAY)) AS DATE) AS event_date)""")
def weekly_dataset_absent_week(spark, sf_dir):
    """Weeks before the first event: zeros for every site, week and day, and no lists."""
    sunday = dt.date(2023, 12, 31)
    span = d.Span(Week.of(sunday).earlier().monday, sunday).reaching_back(d.LOOKBACK)
    return weekly.closed_week_dataset(d.silver(spark, sf_dir, span), sunday, force=True)


@registered("week_buckets", f"""SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, site, {big("sum(sessoes)")} AS sessoes
    FROM vw_site_overview GROUP BY ALL""")
def week_buckets(spark, sf_dir):
    rows = gold.vw_site_overview(d.silver(spark, sf_dir))
    return rows.groupBy(week_start(F.col("event_date")).alias("week"), "site").agg(F.sum("sessoes").alias("sessoes"))


@registered("week_change", f"""WITH w AS (SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, site, {big("sum(sessoes)")} AS sessoes
      FROM vw_site_overview GROUP BY ALL), p AS (SELECT *, lag(sessoes) OVER (PARTITION BY site ORDER BY week) AS previous FROM w)
    SELECT week, site, sessoes, previous, CAST(sessoes - previous AS DOUBLE) / NULLIF(previous, 0) AS change FROM p""")
def week_change(spark, sf_dir):
    return period_change(week_buckets(spark, sf_dir), ["site"], "week", "sessoes")


@registered("theme_shares", f"""SELECT tema, acessos, acessos / {big("sum(acessos) OVER ()")} AS share
    FROM (SELECT tema, {big("sum(acessos)")} AS acessos FROM vw_paineis_acessos GROUP BY tema)""")
def theme_shares(spark, sf_dir):
    rows = gold.vw_paineis_acessos(d.silver(spark, sf_dir)).groupBy("tema").agg(F.sum("acessos").alias("acessos"))
    return share_of_total(rows, "acessos")
