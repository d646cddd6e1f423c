"""Named queries with, where SQL can express them, the independent statement they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle import with_ctes

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, so that results have the same types in every engine."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
        for f in df.schema
    ])


def register(name: str, run: Run, sql: str | None = None) -> None:
    if name in RUNS:
        raise ValueError(f"query {name} is registered twice")
    RUNS[name] = lambda spark, sf_dir: _plain(run(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = with_ctes(sql)


def registered(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def wrap(run: Run) -> Run:
        register(name, run, sql)
        return run

    return wrap
