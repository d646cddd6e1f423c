"""Continuous form of the load: new response files trigger snapshot, day replacement and control line."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Feed, Settings
from ..plans.load import refresh_silver
from ..sources import delivery, landed
from ..sources.tables import Warehouse


def stream_landed(
    wh: Warehouse, feed: Feed, settings: Settings, path: str, checkpoint: str, clock=None
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop (``availableNow``).

    Pages of one extraction may come in any number of batches, and several extractions in one. An extraction becomes a
    snapshot in the batch that makes it whole, with the delivery time of its last page; of extractions that overlap the
    newest wins day by day, whatever the batch. Truncated files and pages without a header of the feed are set aside
    and hold their extraction back until the page is delivered again. What a batch writes is named by its number, so a
    batch that is replayed after a crash replaces its own staged rows, log lines and quarantine and adds none.
    """
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    def on_batch(batch: DataFrame, number: int) -> None:
        entry = f"{feed.name}-stream-{number:012d}"
        delivery.sweep(wh, feed, entry)
        delivery.stage(wh, feed, batch, entry)
        whole = delivery.open_extractions(wh, feed, entry).where("state = 'whole'").select(
            "extraction", F.concat(F.lit("stream-"), "extraction").alias("snapshot_id"),
            F.col("delivered_at").alias("data_extracao"), "pages", "rows")
        delivery.take(wh, feed, whole, entry, "incremental", now())
        refresh_silver(wh, feed, settings)

    return (
        landed.read_pages(wh.spark.readStream, path).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
