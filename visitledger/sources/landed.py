"""Landed report responses (columnar headers, rows of values) as named records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from ..config import Feed
from ..schemas import LANDED_RESPONSE

#: Column that holds the text of a file that is no whole response.
CORRUPT = "corrupt_text"


def _source[R: (DataFrameReader, DataStreamReader)](reader: R, schema: T.StructType, mode: str) -> R:
    """One JSON object per file, in folders of any depth."""
    options = {"multiLine": "true", "recursiveFileLookup": "true", "mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    return reader.schema(schema).options(**options)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Response files with the explicit schema. A truncated file stops the job."""
    return _source(spark.read, LANDED_RESPONSE, "FAILFAST").json(path)


def read_pages(reader: DataFrameReader | DataStreamReader, path: str, extraction: str | None = None) -> DataFrame:
    """Response files, one row each, with the extraction and page they belong to. Nothing stops the job.

    A page's number follows ``page`` and one of ``-_=`` in its path; a file without one is a page of its own. The
    extraction is what follows ``extraction=``, or what stands before ``page`` in the file's name, or the folder of
    numbered pages, or the name of a file without a number; a given ``extraction`` holds for all files. The time of
    delivery is the file's. A truncated file has its text in ``corrupt_text`` and no rows.
    """
    schema = T.StructType([*LANDED_RESPONSE.fields, T.StructField(CORRUPT, T.StringType())])
    files = _source(reader, schema, "PERMISSIVE").json(path)
    where, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    number = F.regexp_extract(where, r"page[-_=](\d+)[^/]*(?:/[^/]*)?$", 1)
    before = F.regexp_extract(name, r"^(.+?)[-_.]?page[-_=]\d+", 1)
    folder = F.regexp_extract(where, r"([^/]+)/[^/]+$", 1)
    stated = F.regexp_extract(where, r"extraction=([^/]+)/", 1)
    filled = lambda c: F.when(c != "", c)
    whose = F.coalesce(filled(stated), filled(before), F.when(number != "", folder), F.regexp_extract(name, r"^(.*?)(?:\.[^.]*)?$", 1))
    return files.select(
        *files.columns, (F.lit(extraction) if extraction else whose).alias("extraction"),
        F.coalesce(filled(number), name).alias("page"), where.alias("path"),
        F.convert_timezone(None, F.lit("UTC"), F.col("_metadata.file_modification_time").cast("timestamp_ntz")).alias("delivered_at"),
    )


def _names() -> Column:
    return F.concat(F.col("dimensionHeaders.name"), F.col("metricHeaders.name"))


def missing_headers(feed: Feed) -> Column:
    """Fields of the feed that a response does not carry."""
    expected = F.array(*[F.lit(f) for f in feed.fields])
    return F.array_except(expected, F.coalesce(_names(), F.array().cast("array<string>")))


def _record(dimensions: str, metrics: str) -> Column:
    """A map from header to cell: cells beyond the headers are ignored, headers without a cell give NULL."""
    values = F.concat(_paired("dimensionHeaders", dimensions), _paired("metricHeaders", metrics))
    return F.map_from_arrays(_names(), values)


def _fields(feed: Feed, record: str) -> list[Column]:
    return [F.try_element_at(record, F.lit(name)).alias(name) for name in feed.fields]


def has_day() -> Column:
    """Whether the record's date is a day of the calendar."""
    real_day = F.try_to_timestamp("date", F.lit("yyyyMMdd")).isNotNull()
    return F.coalesce(F.col("date").rlike("^[0-9]{8}$") & real_day, F.lit(False))


def flatten(responses: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(records, rejected rows).

    A record has one string column per field of the feed; a field the response does not carry is NULL. Cells
    beyond the headers are ignored, and headers without a cell give NULL, as when the two are paired up to the
    shorter one. Rows without a readable date cannot be assigned to a day and are rejected.
    """
    rows = responses.select("dimensionHeaders", "metricHeaders", F.inline("rows"))
    records = rows.select(_record("dimensionValues", "metricValues").alias("_r")).select(*_fields(feed, "_r"))
    return records.where(has_day()), records.where(~has_day())


def page_rows(pages: DataFrame, feed: Feed) -> DataFrame:
    """The rows of delivered pages as records, beside what the page says of itself.

    A page without rows, and a corrupt one, is one row without a ``row_no``.
    """
    kept = ["extraction", "page", "path", "delivered_at", "declared", "missing", CORRUPT, "row_no"]
    rows = pages.withColumn("declared", F.col("rowCount")).withColumn("missing", missing_headers(feed)).select(
        *kept[:-1], "dimensionHeaders", "metricHeaders", F.posexplode_outer("rows").alias("row_no", "row"))
    read = rows.select(*kept, _record("row.dimensionValues", "row.metricValues").alias("_r"))
    return read.select(*kept, *_fields(feed, "_r"))


def _paired(headers: str, cells: str) -> Column:
    """Cell values brought to the number of headers: extra cells dropped, missing ones NULL."""
    return F.transform(F.col(headers), lambda _, i: F.get(F.col(cells), i)["value"])


def collection_gaps(responses: DataFrame) -> DataFrame:
    """Time zone and data-loss timestamp the service reported, once per distinct pair."""
    return responses.select(
        F.col("metadata.timeZone").alias("time_zone"),
        F.col("metadata.dataLossFromGapsTimestamp").alias("data_loss_from"),
    ).distinct()
