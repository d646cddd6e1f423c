"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# The white space between words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, lengthened until no column has that name (names are compared without case)."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base += "_"
    return base


def named(name: str) -> Column:
    """The column of exactly that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


#: While a step is written: shuffle files go with the job, and a Python worker gets batches of at most 8 MB, since texts
#: are long and the default is 64 MB, which Spark and the worker both hold.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                  "spark.sql.execution.arrow.maxBytesPerBatch": "8MB"}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table in the shared folder and read again: later jobs do not depend on lost executors.

    Once the table is there its shuffle files serve nobody, so Spark is asked to remove them with the job.
    """
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, name)
    before = {key: spark.conf.get(key) for key in _WHILE_WRITING}
    try:
        for key, value in _WHILE_WRITING.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
