"""Declared constraints as check queries: one row per rule with the number of violating rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Constraints


def check_table(name: str, df: DataFrame, rules: Constraints, tables: dict[str, DataFrame]) -> DataFrame:
    """All row-level rules share one scan; each key or reference adds one aggregation or anti join."""
    row_rules: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    row_rules += [("max_length", c, F.length(c) > n) for c, n in rules.max_length]
    parts: list[DataFrame] = []
    if row_rules:
        counted = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(row_rules)])
        listed = F.inline(F.array(*[
            F.struct(F.lit(name).alias("tabela"), F.lit(rule).alias("rule"), F.lit(col).alias("target"),
                     F.col(f"r{i}").alias("violations"))
            for i, (rule, col, _) in enumerate(row_rules)
        ]))
        parts.append(counted.select(listed))
    for key in rules.unique:
        repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(_count(repeated, name, "unique", ",".join(key)))
    for col, other, other_col in rules.references:
        known = tables[other].select(F.col(other_col).alias(col))
        orphans = df.where(F.col(col).isNotNull()).join(known, col, "left_anti")
        parts.append(_count(orphans, name, "references", f"{col}->{other}.{other_col}"))
    return reduce(DataFrame.unionByName, parts)


def enforced(name: str, rows: DataFrame, rules: Constraints) -> DataFrame:
    """The rows themselves; reading one that breaks a row-level rule fails, naming table, column and value.

    The test is part of the projection that writes the rows, so it costs no scan, and a write that fails commits nothing.
    """
    longest = dict(rules.max_length)

    def checked(column: str) -> Column:
        value = F.col(column)
        bad = []
        if column in rules.not_null:
            bad.append((value.isNull(), F.lit(f"{name}.{column} is NULL")))
        if column in longest:
            said = F.concat(F.lit(f"{name}.{column} is longer than {longest[column]}: "), value)
            bad.append((F.length(value) > longest[column], said))
        for broken, message in bad:
            value = F.when(broken, F.raise_error(message)).otherwise(value)
        return value.alias(column)

    return rows.select(*[checked(c) for c in rows.columns])


def _count(bad: DataFrame, name: str, rule: str, target: str) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("tabela"), F.lit(rule).alias("rule"), F.lit(target).alias("target"), "violations"
    )


def repeated_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    """Keys that occur more than once at a grain that should be unique."""
    return df.groupBy(*grain).agg(F.count("*").alias("n")).where("n > 1")


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def missing_in_file(spark: SparkSession, path: str, expected: list[str]) -> list[str]:
    """Expected columns that a Parquet table lacks by its own footers, not by a schema declared for reading it."""
    return missing_columns(spark.read.option("mergeSchema", "true").parquet(path), expected)
