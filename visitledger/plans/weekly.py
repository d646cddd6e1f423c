"""Weekly figures: Monday to Sunday against the week before.

Non-additive columns (users of a window, *_7d sums) are read on the Sunday, additive ones are summed over the week.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import seeds
from ..functions.dates import Week
from ..functions.text import (
    change, change_arrow, change_phrase, headline, lookup, ratio, ratio_or_zero, state_name,
)
from ..operators.ranking import against_top, numbered, share_of_total, top
from .gold import Silver, vw_paineis_acessos, vw_site_overview, vw_usuarios_ativos
from .quality import week_completeness

WEEK = 7


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def _on(day: dt.date, column: str) -> Column:
    return F.sum(F.when(F.col("event_date") == F.lit(day), F.col(column)))


def _two_weeks(silver: Silver, sunday: dt.date) -> DataFrame:
    """Active users of the week and the week before, with a row of zeros for every site and day, from one read."""
    now = Week.of(sunday)
    first, last = now.earlier().monday, now.sunday
    rows = vw_usuarios_ativos(silver, first, last)
    sites = F.array(*[F.lit(rule.label) for rule in silver.settings.sites])
    frame = rows.sparkSession.range(1).select(F.explode(sites).alias("site")).select(
        "site", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("event_date"))
    end = F.when(F.col("event_date") >= F.lit(now.monday), F.lit(last)).otherwise(F.lit(now.earlier().sunday))
    return rows.unionByName(frame, allowMissingColumns=True).withColumn("week_end", end)


#: Sums of a site and week: those of the Sunday, where windows overlap, and the users of all days.
def _week_sums() -> list[Column]:
    last = F.col("event_date") == F.col("week_end")

    def sunday_only(column: str) -> Column:
        return _zero(F.sum(F.when(last, F.col(column))))

    return [
        sunday_only("wau").alias("wau"), sunday_only("mau").alias("mau"), sunday_only("sessoes_7d").alias("sessoes"),
        sunday_only("sessoes_engajadas_7d").alias("engajadas"),
        sunday_only("tempo_engajamento_7d_s").cast("double").alias("tempo_s"), _zero(F.sum("dau")).alias("dau_total"),
    ]


def _kpis() -> dict[str, Column]:
    return {
        "wau": F.col("wau"), "mau": F.col("mau"), "sessoes": F.col("sessoes"), "engajadas": F.col("engajadas"),
        "sessoes_dia": F.col("sessoes") / WEEK,
        "dau_medio": F.col("dau_total") / WEEK,
        "tempo_sessao": ratio_or_zero(F.col("tempo_s"), F.col("sessoes")),
        "visitas_usuario": ratio_or_zero(F.col("sessoes"), F.col("wau")),
        "engajadas_pct": ratio(F.col("engajadas"), F.col("sessoes")),
        "frequencia": ratio(F.col("dau_total") / WEEK, F.col("wau")),
    }


def site_kpis(silver: Silver, sunday: dt.date) -> DataFrame:
    """One row per site and week (``current``, ``previous``), zeros where there are no data."""
    totals = _two_weeks(silver, sunday).groupBy("site", "week_end").agg(*_week_sums())
    return totals.select("site", "week_end", *[c.alias(n) for n, c in _kpis().items()])


def site_change(kpis: DataFrame, sunday: dt.date) -> DataFrame:
    """Weekly users of both weeks per site, their change, and the labels the report prints beside it."""
    both = kpis.groupBy("site").agg(
        _zero(F.sum(F.when(F.col("week_end") == F.lit(sunday), F.col("wau")))).alias("wau"),
        _zero(F.sum(F.when(F.col("week_end") < F.lit(sunday), F.col("wau")))).alias("wau_previous"),
    ).withColumn("wau_change", change(F.col("wau"), F.col("wau_previous")))
    return both.select(
        "*",
        change_phrase(F.col("wau_change")).alias("phrase"),
        change_arrow(F.col("wau_change")).alias("arrow"),
    )


def week_headline(changes: DataFrame, silver: Silver) -> DataFrame:
    """The one-sentence summary over both sites."""
    panel, home = silver.settings.panel_site.label, silver.settings.home_site.label

    def of(site: str) -> Column:
        return F.max(F.when(F.col("site") == site, F.col("wau_change")))

    return changes.agg(of(panel).alias("panel_change"), of(home).alias("home_change")).withColumn(
        "headline", headline(panel, F.col("panel_change"), home, F.col("home_change"))
    )


def daily_users(silver: Silver, site: str, sunday: dt.date) -> DataFrame:
    """DAU of each day of the week; a day without data counts as 0."""
    monday, sunday = Week.of(sunday)
    rows = vw_usuarios_ativos(silver, monday, sunday).where(F.col("site") == site)
    found = rows.groupBy("event_date").agg(_zero(F.sum("dau")).alias("dau"))
    days = silver.ga4_usuarios.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(monday), F.lit(sunday))).alias("event_date")
    )
    return days.join(found, "event_date", "left").fillna(0, ["dau"])


def top_countries(silver: Silver, sunday: dt.date, limit: int = 5) -> DataFrame:
    rows = vw_usuarios_ativos(silver, sunday, sunday)
    best = rows.groupBy("country").agg(_zero(F.sum("wau")).alias("wau")).where("wau > 0")
    return top(best, limit, F.desc("wau"), F.asc("country")).select(
        lookup(F.col("country"), seeds.COUNTRY_NAMES).alias("country"), "wau"
    )


def top_states(silver: Silver, sunday: dt.date, limit: int = 5) -> DataFrame:
    monday, sunday = Week.of(sunday)
    rows = vw_site_overview(silver, monday, sunday).where(
        (F.col("country") == silver.settings.home_country) & (F.col("region") != "(not set)")
    )
    best = rows.groupBy("region").agg(_zero(F.sum("sessoes")).alias("sessoes")).where("sessoes > 0")
    return top(best, limit, F.desc("sessoes"), F.asc("region")).select(
        state_name(F.col("region"), seeds.STATE_NAMES).alias("state"), "sessoes"
    )


def devices(silver: Silver, sunday: dt.date, limit: int | None = None) -> DataFrame:
    rows = vw_usuarios_ativos(silver, sunday, sunday).where(F.col("site") == silver.settings.panel_site.label)
    best = rows.groupBy("device_category").agg(_zero(F.sum("wau")).alias("wau")).where("wau > 0")
    shared = share_of_total(best, "wau")
    return top(shared, limit, F.desc("wau"), F.asc("device_category")).select(
        lookup(F.col("device_category"), seeds.DEVICE_NAMES).alias("device"), "wau", "share"
    )


def panel_week(silver: Silver, sunday: dt.date) -> DataFrame:
    """Accesses summed over the week, people of the week read on the Sunday; ranked panels only."""
    monday, sunday = Week.of(sunday)
    rows = vw_paineis_acessos(silver, monday, sunday).where(F.col("tipo") == "painel")
    return rows.groupBy("painel", "tema").agg(
        _zero(F.sum("acessos")).alias("acessos"), _zero(_on(sunday, "pessoas_7d")).alias("pessoas")
    ).where("acessos > 0")


def top_panels(silver: Silver, sunday: dt.date, limit: int | None = None) -> DataFrame:
    """Accesses, then people, then name."""
    order = (F.desc("acessos"), F.desc("pessoas"), F.asc("painel"))
    return top(panel_week(silver, sunday), limit, *order)


def panel_bars(silver: Silver, sunday: dt.date, limit: int = 6) -> DataFrame:
    """Top panels with position and bar width relative to the first."""
    order = (F.desc("acessos"), F.desc("pessoas"), F.asc("painel"))
    return against_top(numbered(top_panels(silver, sunday, limit), *order), "acessos")


def top_theme(silver: Silver, sunday: dt.date) -> DataFrame:
    """Theme with most accesses and its share; ties go to the theme of the better-placed panel."""
    rows = panel_week(silver, sunday)
    place = F.min(F.struct((-F.col("acessos")).alias("a"), (-F.col("pessoas")).alias("p"), "painel"))
    themes = rows.groupBy("tema").agg(F.sum("acessos").alias("acessos"), place.alias("_place"))
    shared = share_of_total(themes, "acessos")
    return top(shared, 1, F.desc("acessos"), F.asc("_place")).select("tema", "acessos", "share")


# ---- the whole result ----------------------------------------------------------------------------------------------

#: KPIs of a site that the result lists.
SITE_KPIS = ("wau", "mau", "sessoes", "engajadas", "sessoes_dia", "dau_medio", "tempo_sessao", "visitas_usuario")


def _user_sections(silver: Silver, sunday: dt.date) -> DataFrame:
    """Sites and weeks, days, countries and devices as grouping sets of one pass over the user feed."""
    panel_site = silver.settings.panel_site.label
    rows = _two_weeks(silver, sunday).withColumn("on_sunday", F.when(F.col("event_date") == F.lit(sunday), F.col("wau")))
    sets = [["site", "week_end"], ["site", "event_date"], ["country"], ["site", "device_category"]]
    names = ["site", "week_end", "event_date", "country", "device_category"]
    sums = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
        *[F.grouping(c).alias(f"no_{c}") for c in names], *_week_sums(), _zero(F.sum("on_sunday")).alias("now"))
    has = lambda c: F.col(f"no_{c}") == 0
    section = (F.when(has("week_end"), "site").when(has("event_date"), "day").when(has("country"), "country")
               .otherwise("device"))
    member = (F.when(has("week_end"), F.col("site")).when(has("event_date"), F.col("event_date").cast("string"))
              .when(has("country"), F.col("country")).otherwise(F.col("device_category")))
    listed = sums.select("*", section.alias("section"), member.alias("raw"))
    monday = Week.of(sunday).monday
    wanted = (
        (F.col("section") == "site")
        | (F.col("section") == "day") & (F.col("site") == panel_site) & (F.col("event_date") >= F.lit(monday))
        | (F.col("section") == "country") & (F.col("now") > 0)
        | (F.col("section") == "device") & (F.col("site") == panel_site) & (F.col("now") > 0)
    )
    placed = listed.where(wanted).withColumn("_place", F.row_number().over(
        Window.partitionBy("section").orderBy(F.desc("now"), F.asc("raw"))))
    kept = placed.where((F.col("section") != "country") | (F.col("_place") <= 5))
    label = (F.when(F.col("section") == "country", lookup(F.col("raw"), seeds.COUNTRY_NAMES))
             .when(F.col("section") == "device", lookup(F.col("raw"), seeds.DEVICE_NAMES)).otherwise(F.col("raw")))
    kpis = _kpis()
    pair = lambda name, value: F.struct(F.lit(name).alias("kpi"), value.cast("double").alias("value"))
    listing = (F.when(F.col("section") == "site", F.array(*[pair(n, kpis[n]) for n in SITE_KPIS]))
               .when(F.col("section") == "day", F.array(pair("dau", F.col("dau_total"))))
               .otherwise(F.array(pair("wau", F.col("now")))))
    return kept.select("section", label.alias("member"), F.coalesce("week_end", F.lit(sunday)).alias("week_end"),
                       F.inline(listing))


def _state_section(silver: Silver, sunday: dt.date) -> DataFrame:
    return top_states(silver, sunday).select(
        F.lit("state").alias("section"), F.col("state").alias("member"), F.lit(sunday).alias("week_end"),
        F.lit("sessoes").alias("kpi"), F.col("sessoes").cast("double").alias("value"))


def _panel_sections(silver: Silver, sunday: dt.date) -> DataFrame:
    """Panels and the top theme from one pass over the page feed. Panels are few, so windows over them are small."""
    by_theme, all_panels = Window.partitionBy("tema"), Window.partitionBy("section")
    place = F.struct((-F.col("acessos")).alias("a"), (-F.col("pessoas")).alias("p"), "painel")
    panels = panel_week(silver, sunday).withColumn("section", F.lit("panel")).select(
        "*", F.sum("acessos").over(by_theme).alias("of_theme"), F.min(place).over(by_theme).alias("theme_place"),
        F.sum("acessos").over(all_panels).alias("of_all"), place.alias("place"))
    best = F.row_number().over(all_panels.orderBy(F.desc("of_theme"), F.asc("theme_place"), F.asc("place")))
    pair = lambda section, member, name, value: F.struct(
        F.lit(section).alias("section"), F.col(member).alias("member"), F.lit(sunday).alias("week_end"),
        F.lit(name).alias("kpi"), value.cast("double").alias("value"))
    theme = F.when(F.col("_best") == 1, pair("theme", "tema", "share", ratio(F.col("of_theme"), F.col("of_all"))))
    return panels.withColumn("_best", best).select(F.inline(F.array_compact(F.array(
        pair("panel", "painel", "acessos", F.col("acessos")), pair("panel", "painel", "pessoas", F.col("pessoas")), theme))))


def weekly_dataset(silver: Silver, sunday: dt.date) -> DataFrame:
    """The whole weekly result as rows of (section, member, week_end, kpi, value), one pass over each feed."""
    return reduce(DataFrame.unionByName, [
        _user_sections(silver, sunday), _state_section(silver, sunday), _panel_sections(silver, sunday)])


def closed_week_dataset(silver: Silver, sunday: dt.date, force: bool = False) -> DataFrame:
    """The weekly result behind its gate: reading it fails while the week is incomplete, unless ``force`` is given.

    The check is part of the plan and runs when the result is read; nothing runs while it is built.
    """
    result = weekly_dataset(silver, sunday)
    if force:
        return result
    said = F.array_join(F.sort_array(F.collect_list(F.concat_ws(": ", "tabela", "problem"))), ", ")
    problems = week_completeness(silver, sunday).agg(said.alias("said")).scalar()
    stop = F.raise_error(F.concat(F.lit(f"the week of {sunday} is incomplete: "), problems))
    return result.where(F.when(problems == "", F.lit(True)).otherwise(stop))
