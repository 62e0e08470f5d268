"""Incremental ingestion: documents that land in a folder update the stored ones by openid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ingest, maintenance
from ..sources import landing, replace_documents
from ..sources.store import Store


def latest(documents: DataFrame) -> DataFrame:
    """One version of each openid: the last updated, and of equal ones the greatest by content."""
    order = Window.partitionBy("openid").orderBy(F.desc("lastUpdated"), F.desc(F.xxhash64(*(c for c in documents.columns))))
    return documents.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def run(spark, source: str, target: str, checkpoint: str, available_now: bool = True):
    """Starts the stream; each batch replaces only the partitions of its own openids, so a repeated batch changes nothing."""
    writer = landing(spark, source).writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: replace_documents(latest(batch), target))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_store(spark, source: str, store: Store, checkpoint: str, stream: str = "landing", available_now: bool = True):
    """Starts the stream into a store: documents with their standings, and the indexes, change by one version a batch.

    A batch that comes again after a crash is in the store's ledger if it got there, and then changes nothing.
    """

    def put(batch: DataFrame, number: int) -> None:
        maintenance.follow(store, ingest.with_standings(latest(batch)), (stream, number))

    writer = landing(spark, source).writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def event_counts(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Windowed counts by type with a watermark: an addition of this engine for streams of events."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
