"""Panel names and URL targets resolved against the panel dimensions.

The lookups carry no hint: adaptive execution broadcasts one whose measured bytes allow it and shuffles a larger one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_map(dim_painel: DataFrame, dim_alias: DataFrame) -> DataFrame:
    """raw name -> attributes of the active panel; a panel's own name wins over an alias of the same text.

    Built from the dimensions alone, so the fact table needs a single join.
    """
    active = dim_painel.where("ativo")
    own = active.withColumn("nome_painel_raw", F.col("painel"))
    alias = dim_alias.join(active, "painel").withColumnRenamed("alias", "nome_painel_raw")
    extra = alias.join(own.select("nome_painel_raw"), "nome_painel_raw", "left_anti")
    return own.unionByName(extra)


def resolve_names(paineis: DataFrame, dim_painel: DataFrame, dim_alias: DataFrame) -> DataFrame:
    """Every row keeps its raw name and gains ``painel`` (NULL when unknown)."""
    names = name_map(dim_painel, dim_alias).select("nome_painel_raw", "painel")
    return paineis.join(names, "nome_painel_raw", "left")


def with_panel(paineis: DataFrame, dim_painel: DataFrame, dim_alias: DataFrame, tipo: str = "painel") -> DataFrame:
    """Rows of known panels of one type, with the panel's attributes."""
    names = name_map(dim_painel, dim_alias).where(F.col("tipo") == tipo)
    names = names.select("nome_painel_raw", "painel", "ordem_menu", "tema", "hierarquia")
    return paineis.join(names, "nome_painel_raw")


def unmatched_names(paineis: DataFrame, dim_painel: DataFrame, dim_alias: DataFrame) -> DataFrame:
    names = name_map(dim_painel, dim_alias).select("nome_painel_raw")
    return paineis.join(names, "nome_painel_raw", "left_anti")


def target_map(dim_relatorio: DataFrame, dim_painel: DataFrame) -> DataFrame:
    """URL target -> version and attributes of the active panel."""
    return dim_relatorio.join(dim_painel.where("ativo"), "painel")


def with_target(paginas: DataFrame, dim_relatorio: DataFrame, dim_painel: DataFrame) -> DataFrame:
    """Page rows of mapped targets with the panel's attributes."""
    return paginas.join(target_map(dim_relatorio, dim_painel), "alvo")


def unmapped_targets(paginas: DataFrame, dim_relatorio: DataFrame) -> DataFrame:
    """Page rows whose target is not in the map; an unreadable (NULL) target is unmapped."""
    return paginas.join(dim_relatorio.select("alvo"), "alvo", "left_anti")


def mark_targets(paginas: DataFrame, dim_relatorio: DataFrame) -> DataFrame:
    """All page rows with ``mapeado``, in one pass."""
    known = dim_relatorio.select("alvo").distinct().withColumn("mapeado", F.lit(True))
    return paginas.join(known, "alvo", "left").fillna(False, ["mapeado"])
