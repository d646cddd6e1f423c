"""Star schema around the views and the measure query used by every dashboard visual."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_name, month_short
from ..functions.text import ratio
from .gold import VIEWS, Silver
from .measures import MEASURES, Base, Derived

CALENDAR = ("ano", "numero_mes", "mes", "mes_e_ano", "trimestre", "dia_da_semana", "nome_do_dia")
REGION = ("estado", "uf", "pais")


# ---- lookups -------------------------------------------------------------------------------------------------------

def with_calendar(df: DataFrame, day: str = "event_date") -> DataFrame:
    """Calendar attributes of a day. They are functions of the date, so facts need no join to get them."""
    date = F.col(day)
    return df.select(
        "*",
        F.year(date).alias("ano"),
        F.month(date).alias("numero_mes"),
        month_short(date).alias("mes"),
        F.concat_ws("/", month_short(date), F.year(date).cast("string")).alias("mes_e_ano"),
        F.concat(F.lit("T"), F.quarter(date).cast("string")).alias("trimestre"),
        F.dayofweek(date).alias("dia_da_semana"),
        day_name(date).alias("nome_do_dia"),
    )


def calendar(span: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day of the whole years that cover a one-row span."""
    start = F.trunc(first, "YEAR")
    end = F.date_sub(F.add_months(F.trunc(last, "YEAR"), 12), 1)
    return with_calendar(span.select(F.explode(F.sequence(start, end)).alias("event_date")))


def with_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """State, code and country of a delivered region; unmatched regions keep the blank member (NULL)."""
    return df.join(regions.withColumnRenamed("region_ga4", "region"), "region", "left")


# ---- filters of a visual -------------------------------------------------------------------------------------------

def members(column: str, *values: str) -> Column:
    return F.col(column).isin(*values)


def exclude(column: str, *values: str) -> Column:
    """Drop members, and always the missing one."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def from_day(start: dt.date, end: dt.date | None = None) -> Column:
    day = F.col("event_date")
    return (day >= F.lit(start)) if end is None else day.between(F.lit(start), F.lit(end))


# ---- measures ------------------------------------------------------------------------------------------------------

def _bases(names: Sequence[str]) -> dict[str, Base]:
    out: dict[str, Base] = {}
    for name in names:
        m = MEASURES[name]
        out.update({name: m} if isinstance(m, Base) else _bases(m.parts))
    return out


def _with_derived(df: DataFrame, names: Sequence[str]) -> DataFrame:
    for name in names:
        m = MEASURES[name]
        if isinstance(m, Derived):
            df = _with_derived(df, m.parts)
            if name not in df.columns:
                df = df.withColumn(name, m.expression())
    return df


def query(
    silver: Silver,
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Sequence[Column] = (),
    regions: DataFrame | None = None,
    totals: bool = False,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Measures at any grouping: columns ``by`` followed by the measures, in the order asked for.

    Measures of one view are aggregated together; views meet by union and re-aggregation, which keeps members that
    only one of them has and matches missing members with each other. Ratios are formed last, so with
    ``totals=True`` (grand total and subtotals, told apart by ``level``) they are ratios of totals.
    A grouping the view does not have is an error: repeating the grand total on every member would be wrong.
    """
    by_view: dict[str, dict[str, Base]] = {}
    for name, base in _bases(names).items():
        by_view.setdefault(base.view, {})[name] = base
    keys = ["level", *by] if totals else list(by)
    parts = []
    for view, bases in by_view.items():
        dated = view != "vw_paineis_sem_mapeamento"
        rows = VIEWS[view](silver, start, end)
        if dated and any(c in CALENDAR for c in by):
            rows = with_calendar(rows)
        if regions is not None and any(c in REGION for c in by):
            rows = with_region(rows, regions)
        unknown = [c for c in by if c not in rows.columns]
        if unknown:
            raise ValueError(f"{view} cannot be grouped by {', '.join(unknown)}")
        rows = reduce(DataFrame.where, where, rows)
        aggregates = [b.expression().alias(n) for n, b in bases.items()]
        if totals:
            parts.append(rows.rollup(*by).agg(F.grouping_id().alias("level"), *aggregates))
        else:
            parts.append(rows.groupBy(*by).agg(*aggregates))
    if len(parts) == 1:
        merged = parts[0]
    else:
        columns = [c for bases in by_view.values() for c in bases]
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        merged = merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
    return _with_derived(merged, names).select(*keys, *names)


def by_category(silver: Silver, name: str, category: str, **options) -> DataFrame:
    """Bars and donuts: one measure by one category, largest first."""
    return query(silver, [name], [category], **options).orderBy(F.desc_nulls_last(name), F.asc_nulls_last(category))


def device_matrix(silver: Silver, devices: Sequence[str], start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Panel x device sessions, from the view that has both columns."""
    rows = VIEWS["vw_engajamento_dispositivo"](silver, start, end)
    return rows.groupBy("painel").pivot("device_category", list(devices)).agg(F.sum("sessoes"))


def shares_of(df: DataFrame, *columns: str) -> DataFrame:
    """100% stacked: each column as a share of their sum."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])
    return df.select("*", *[ratio(F.coalesce(F.col(c), F.lit(0)), total).alias(f"{c}_share") for c in columns])


def map_points(silver: Silver, regions: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Map: smallest region code, bubble size and tooltip by country."""
    rows = with_region(VIEWS["vw_sessoes"](silver, start, end), regions)
    return rows.groupBy("country").agg(
        F.min("uf").alias("uf"),
        MEASURES["sessoes_validas"].expression().alias("sessoes_validas"),
        MEASURES["usuarios_ativos"].expression().alias("usuarios_ativos"),
    )
