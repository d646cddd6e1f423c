"""Parquet tables below one root: creation, reading with a fixed schema, day replacement and whole replacement.

A table that can be replaced as a whole (silver, dimensions) is a folder of versions. Which one counts is told by the
last of the empty files in its ``_versions`` folder, named by number and version. A replacement writes a version beside
the others, and the file that names it is the switch: it appears in one step on every file system, nothing is ever
overwritten or moved, and until then readers and later runs see the old table whole.

A log is a folder of entries. An entry is written under a name that its load decides, so a load that is repeated after
a crash replaces its own lines and adds none.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FEEDS, Feed
from ..schemas import DIMENSIONS, LOGS, SILVER, payload_schema

#: Until a table is replaced as a whole.
FIRST_VERSION = "first"


@dataclass(frozen=True)
class Warehouse:
    """bronze/<feed>, silver/<table>, dims/<table> and small logs below one root folder."""

    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # -- schemas -------------------------------------------------------------------------------------------------
    @staticmethod
    def bronze_schema(feed: Feed) -> T.StructType:
        fields = [f for f in payload_schema(feed).fields]
        return T.StructType([
            *fields,
            T.StructField("data_extracao", T.TimestampNTZType()),
            T.StructField("event_date", T.DateType()),
            T.StructField("snapshot_id", T.StringType()),
        ])

    def create_all(self) -> None:
        """Folders of the tables that do not exist yet; an empty folder reads as an empty table of its schema."""
        for feed in FEEDS.values():
            self._create("bronze", feed.name)
            self._create("landing", feed.name)
            self._create("silver", feed.table, FIRST_VERSION)
        for log in LOGS:
            self._create("log", log)
        for dim in DIMENSIONS:
            self._create("dims", dim, FIRST_VERSION)

    def _folder(self, *parts: str):
        """(file system, path) of a folder, on whatever storage the root is."""
        spark = self.spark
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path

    def _create(self, *parts: str) -> None:
        fs, path = self._folder(*parts)
        fs.mkdirs(path)

    def exists(self, folder: str) -> bool:
        """Whether a folder anywhere is there."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def delete(self, *parts: str) -> None:
        fs, path = self._folder(*parts)
        fs.delete(path, True)

    # -- versions ------------------------------------------------------------------------------------------------
    def _switches(self, *parts: str) -> list[str]:
        fs, path = self._folder(*parts, "_versions")
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def current(self, *parts: str) -> str:
        """Folder of the version that counts."""
        switches = self._switches(*parts)
        return self.path(*parts, switches[-1].split("-", 1)[1] if switches else FIRST_VERSION)

    def _replace(self, rows: DataFrame, *parts: str, partitions: tuple[str, ...] = ()) -> None:
        """A new version beside the others, then the switch; of the old versions the last stays for plans that read it."""
        version = uuid.uuid4().hex
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(
            self.path(*parts, version))
        self._switch(version, *parts)
        self._retire(*parts)

    def _switch(self, version: str, *parts: str) -> None:
        number = int(switches[-1].split("-", 1)[0]) + 1 if (switches := self._switches(*parts)) else 1
        fs, path = self._folder(*parts, "_versions", f"{number:012d}-{version}")
        fs.create(path, False).close()

    def _retire(self, *parts: str) -> None:
        """Remove versions before the last two, and what interrupted replacements left."""
        fs, path = self._folder(*parts)
        kept = {s.split("-", 1)[1] for s in self._switches(*parts)[-2:]} | {"_versions"}
        if len(kept) < 3:
            kept.add(FIRST_VERSION)
        for folder in [f.getPath().getName() for f in fs.listStatus(path)]:
            if folder not in kept:
                self.delete(*parts, folder)

    # -- reading -------------------------------------------------------------------------------------------------
    def bronze(self, feed: Feed) -> DataFrame:
        return self.spark.read.schema(self.bronze_schema(feed)).parquet(self.path("bronze", feed.name))

    def silver(self, table: str) -> DataFrame:
        schema = SILVER[table]
        return self.spark.read.schema(schema).parquet(self.current("silver", table)).select(*schema.names)

    def log(self, name: str) -> DataFrame:
        """Lines of a log, with the ``entry`` they were written under."""
        schema = T.StructType([*LOGS[name].fields, T.StructField("entry", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path("log", name))

    def snapshots(self) -> DataFrame:
        return self.log("snapshots").drop("entry")

    def loaded(self) -> DataFrame:
        return self.log("loaded").drop("entry")

    def days(self) -> DataFrame:
        """The last noted statistics of every loaded day of every fact table, one small row each."""
        facts = F.struct("data_extracao", "linhas", "validas")
        newest = F.max_by(facts, F.struct("data_extracao", "executado_em"))
        return self.loaded().groupBy("tabela", "event_date").agg(newest.alias("_day")).select("tabela", "event_date", "_day.*")

    def control(self) -> DataFrame:
        return self.log("control").drop("entry")

    def dim(self, name: str) -> DataFrame:
        return self.spark.read.schema(DIMENSIONS[name]).parquet(self.current("dims", name))

    # -- writing -------------------------------------------------------------------------------------------------
    def note(self, name: str, lines: DataFrame, entry: str | None = None) -> None:
        """Lines of a log under an entry; the same entry again replaces its lines."""
        folder = self.path("log", name, entry_folder(entry or uuid.uuid4().hex))
        lines.select(*LOGS[name].names).write.mode("overwrite").parquet(folder)

    def replace_days(self, table: str, rows: DataFrame, emptied: list[dt.date] | None = None) -> None:
        """Swap whole days: partitions present in ``rows`` are overwritten, other days stay as they are.

        Days named in ``emptied`` lose their partition, because dynamic overwrite only touches partitions it
        writes. Executor loss is harmless: tasks write to a staging folder and finished partitions are moved at
        commit. The swap is per day, not atomic across days; re-running it is idempotent.
        """
        path = self.current("silver", table)
        _by_day(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_date"
        ).parquet(path)
        version = path.rsplit("/", 1)[1]
        for day in emptied or []:
            self.delete("silver", table, version, f"event_date={day.isoformat()}")

    def store_sketches(self, name: str, daily: DataFrame) -> None:
        """Daily user sketches, a folder per day; days that are in ``daily`` are replaced."""
        daily.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_date").parquet(self.path("sketches", name))

    def sketches(self, name: str, keys: T.StructType) -> DataFrame:
        """Stored sketches of the given key columns; a filter on ``event_date`` reads those days only."""
        schema = T.StructType([*keys.fields, T.StructField("sketch", T.BinaryType()), T.StructField("event_date", T.DateType())])
        return self.spark.read.schema(schema).parquet(self.path("sketches", name))

    def replace_all(self, table: str, rows: DataFrame) -> None:
        """Full rebuild: the old table counts until the new one is whole."""
        self._replace(_by_day(rows), "silver", table, partitions=("event_date",))

    def replace_dim(self, name: str, rows: DataFrame) -> None:
        """The new dimension may be computed from the old one, which is still there when it is written."""
        self._replace(rows, "dims", name)


def entry_folder(entry: str) -> str:
    return f"entry={quote(entry, safe='')}"


def _by_day(rows: DataFrame) -> DataFrame:
    """Rows of a day together, with AQE splitting large days and merging small ones to its advisory size."""
    return rows.hint("rebalance", "event_date")
