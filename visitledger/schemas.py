"""Explicit schemas and the constraints the tables must satisfy (nothing is ever inferred)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .config import FEEDS, Feed

_KIND = {
    "date": T.DateType(),
    "dim": T.StringType(),
    "text": T.StringType(),
    "count": T.LongType(),
    "seconds": T.DecimalType(14, 2),
}

VALUE = T.StructType([T.StructField("value", T.StringType())])
HEADER = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))

LANDED_RESPONSE = T.StructType([
    T.StructField("dimensionHeaders", HEADER),
    T.StructField("metricHeaders", HEADER),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("dimensionValues", T.ArrayType(VALUE)),
        T.StructField("metricValues", T.ArrayType(VALUE)),
    ]))),
    T.StructField("rowCount", T.IntegerType()),
    T.StructField("metadata", T.StructType([
        T.StructField("timeZone", T.StringType()),
        T.StructField("dataLossFromGapsTimestamp", T.StringType()),
    ])),
])

SNAPSHOT_LOG = T.StructType([
    T.StructField("relatorio", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("linhas", T.LongType()),
    T.StructField("data_extracao", T.TimestampNTZType()),
])

#: Statistics of a day of a fact table, written when the day was loaded.
LOADED_LOG = T.StructType([
    T.StructField("tabela", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("data_extracao", T.TimestampNTZType()),
    T.StructField("linhas", T.LongType()),
    T.StructField("validas", T.LongType()),
    T.StructField("executado_em", T.TimestampNTZType()),
])

CONTROL_LOG = T.StructType([
    T.StructField("relatorio", T.StringType()),
    T.StructField("tipo_carga", T.StringType()),
    T.StructField("data_inicio_janela", T.DateType()),
    T.StructField("data_fim_janela", T.DateType()),
    T.StructField("qtd_dias", T.IntegerType()),
    T.StructField("qtd_linhas", T.LongType()),
    T.StructField("executado_em", T.TimestampNTZType()),
])

#: One line per delivered file: what it holds, and what keeps it from being used.
PAGE_LOG = T.StructType([
    T.StructField("relatorio", T.StringType()),
    T.StructField("extraction", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("delivered_at", T.TimestampNTZType()),
    T.StructField("declared", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("undated", T.LongType()),
    T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("corrupt", T.BooleanType()),
])

#: One line per extraction that was used: its snapshot and what it was made of.
TAKEN_LOG = T.StructType([
    T.StructField("relatorio", T.StringType()),
    T.StructField("extraction", T.StringType()),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("delivered_at", T.TimestampNTZType()),
    T.StructField("pages", T.LongType()),
    T.StructField("rows", T.LongType()),
])

LOGS = {
    "snapshots": SNAPSHOT_LOG, "loaded": LOADED_LOG, "control": CONTROL_LOG, "pages": PAGE_LOG, "taken": TAKEN_LOG,
}

DIM_PAINEL = T.StructType([
    T.StructField("painel", T.StringType()),
    T.StructField("ordem_menu", T.IntegerType()),
    T.StructField("tema", T.StringType()),
    T.StructField("hierarquia", T.StringType()),
    T.StructField("publico_principal", T.StringType()),
    T.StructField("tipo", T.StringType()),
    T.StructField("ativo", T.BooleanType()),
])

DIM_RELATORIO = T.StructType([
    T.StructField("alvo", T.StringType()),
    T.StructField("painel", T.StringType()),
    T.StructField("versao", T.StringType()),
    T.StructField("fonte", T.StringType()),
])

DIM_ALIAS = T.StructType([
    T.StructField("alias", T.StringType()),
    T.StructField("painel", T.StringType()),
])

DIM_REGIAO = T.StructType([
    T.StructField("region_ga4", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("uf", T.StringType()),
    T.StructField("pais", T.StringType()),
])


def payload_schema(feed: Feed) -> T.StructType:
    """One delivered record: every value is a string."""
    return T.StructType([T.StructField(name, T.StringType()) for name in feed.fields])


def silver_schema(feed: Feed) -> T.StructType:
    """Typed table of a feed, in its published column order."""
    out = []
    for name, kind in feed.fields.values():
        out.append(T.StructField(name, _KIND[kind]))
        if name == "hostname":
            out.append(T.StructField("site", T.StringType()))
        if name == "page_location":
            out.append(T.StructField("alvo", T.StringType()))
    if feed.name == "site":
        out.append(T.StructField("trafego_valido", T.BooleanType()))
    out.append(T.StructField("data_extracao", T.TimestampNTZType()))
    return T.StructType(out)


SILVER = {feed.table: silver_schema(feed) for feed in FEEDS.values()}
DIMENSIONS = {
    "dim_painel": DIM_PAINEL,
    "dim_painel_relatorio": DIM_RELATORIO,
    "dim_painel_alias": DIM_ALIAS,
}


@dataclass(frozen=True)
class Constraints:
    """Declared rules of one table; :mod:`visitledger.operators.constraints` turns them into check queries."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # column, other table, other column


# Declared widths and keys of the published tables.
_GEO_LEN = (("hostname", 120), ("site", 20), ("country", 100), ("region", 120), ("city", 120),
            ("device_category", 20))
CONSTRAINTS: dict[str, Constraints] = {
    "ga4_eventos": Constraints(
        not_null=("event_date", "hostname", "site", "country", "region", "city", "device_category", "browser",
                  "operating_system", "event_name", "trafego_valido"),
        max_length=_GEO_LEN + (("browser", 60), ("operating_system", 60), ("event_name", 80)),
    ),
    "ga4_paineis": Constraints(
        not_null=("event_date", "hostname", "site", "country", "region", "city", "device_category", "event_name",
                  "nome_painel_raw"),
        max_length=_GEO_LEN + (("event_name", 80), ("nome_painel_raw", 200)),
    ),
    "ga4_usuarios": Constraints(
        not_null=("event_date", "hostname", "site", "country", "device_category"),
        max_length=(("hostname", 120), ("site", 20), ("country", 100), ("device_category", 20)),
    ),
    "ga4_paginas": Constraints(
        not_null=("event_date", "hostname", "site", "page_location"),
        max_length=(("hostname", 120), ("site", 20), ("alvo", 120)),
    ),
    "dim_painel": Constraints(
        not_null=("painel", "tipo", "ativo"),
        unique=(("painel",),),
        max_length=(("painel", 120), ("tema", 80), ("hierarquia", 80), ("publico_principal", 160), ("tipo", 20)),
    ),
    "dim_painel_relatorio": Constraints(
        not_null=("alvo", "painel", "versao", "fonte"),
        unique=(("alvo",),),
        max_length=(("alvo", 120), ("painel", 120), ("versao", 10), ("fonte", 20)),
        references=(("painel", "dim_painel", "painel"),),
    ),
    "dim_painel_alias": Constraints(
        not_null=("alias", "painel"),
        unique=(("alias",),),
        max_length=(("alias", 200), ("painel", 120)),
        references=(("painel", "dim_painel", "painel"),),
    ),
}
