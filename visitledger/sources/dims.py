"""Panel dimensions: seeds and their upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import seeds
from ..schemas import DIM_ALIAS, DIM_PAINEL, DIM_REGIAO, DIM_RELATORIO
from .tables import Warehouse


def upsert_soft_delete(old: DataFrame, seed: DataFrame, key: str, active: str) -> DataFrame:
    """Rows of the seed win and are active; rows no longer in the seed stay, marked inactive."""
    s, o = seed.alias("s"), old.alias("o")
    in_seed = F.col(f"s.{key}").isNotNull()
    cols = [
        in_seed.alias(c) if c == active
        else F.when(in_seed, F.col(f"s.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
        for c in old.columns
    ]
    return o.join(s, F.col(f"o.{key}") == F.col(f"s.{key}"), "full").select(*cols)


def upsert(old: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Rows of the seed win; keys the seed does not name survive."""
    return old.join(seed.select(key), key, "left_anti").select(*old.columns).unionByName(seed.select(*old.columns))


def seed_frames(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "dim_painel": spark.createDataFrame([(*row, True) for row in seeds.PANELS], DIM_PAINEL),
        "dim_painel_alias": spark.createDataFrame(list(seeds.ALIASES), DIM_ALIAS),
        "dim_painel_relatorio": spark.createDataFrame(list(seeds.REPORT_IDS), DIM_RELATORIO),
    }


def region_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(seeds.REGIONS), DIM_REGIAO)


def load_dimensions(wh: Warehouse, seed: dict[str, DataFrame] | None = None) -> None:
    """Bring the three dimensions up to date with the seed; running it twice changes nothing."""
    seed = seed or seed_frames(wh.spark)
    wh.replace_dim("dim_painel", upsert_soft_delete(wh.dim("dim_painel"), seed["dim_painel"], "painel", "ativo"))
    wh.replace_dim("dim_painel_alias", upsert(wh.dim("dim_painel_alias"), seed["dim_painel_alias"], "alias"))
    wh.replace_dim("dim_painel_relatorio", upsert(wh.dim("dim_painel_relatorio"), seed["dim_painel_relatorio"], "alvo"))
