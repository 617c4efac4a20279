"""The delivery timeline kept current by Structured Streaming.

The per-order first events (the associative aggregate of the batch timeline) are a streaming
aggregation: Spark holds them in its state store, a micro-batch of any number of files updates the
orders it touches, and a restart goes on from the checkpoint. Each update is the whole state of
an order so far, written under its batch id; a retried batch overwrites its own output. As
every column is a minimum or maximum, older versions of an order change nothing when they are
merged with newer ones, so the timeline is the merge of all that was written, and a late event
corrects its order whenever it arrives.

Without a watermark the state holds one entry per order for good, so no event is ever too late. With
one, state is kept per order and day of event and dropped when the watermark has passed the day; an
event later than that, or one without a time, is then not seen. On a cluster choose the RocksDB
state store (``spark.sql.streaming.stateStore.providerClass``), which keeps state on disk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lastmile.plans import silver as S
from lastmile.session import ensure_checkpoint_dir
from lastmile.sources.schemas import DELIVERY_EVENTS


def read_events(spark: SparkSession, source_dir: str, fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """Event files (JSON lines or Parquet) as a stream."""
    reader = spark.readStream.schema(DELIVERY_EVENTS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def start_timeline_stream(
    events: DataFrame, versions_dir: str, checkpoint_dir: str, watermark: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Keep ``versions_dir`` current with the first events of every order of a stream of events."""
    if watermark:
        timed = events.withColumn("_at", F.col("event_ts").cast("timestamp")).withWatermark("_at", watermark)
        days = timed.groupBy("order_id", F.window("_at", "1 day"))
        firsts = S.first_events(days).drop("window")
    else:
        firsts = S.first_events(events)

    def write_versions(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{versions_dir}/batch={batch_id}")

    writer = firsts.writeStream.outputMode("update").foreachBatch(write_versions).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def timeline_from_versions(spark: SparkSession, versions_dir: str) -> DataFrame:
    """The timeline as of the last finished batch."""
    versions = spark.read.parquet(versions_dir).drop("batch")
    return S.timeline_from_first_events(S.merge_first_events(versions))


def stream_timeline_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery timeline computed by a streaming run over the lineitem table.

    lineitem is read as a file stream and joined to the static orders table (stream-static join) to
    form events. The answer equals the batch ``delivery_timeline`` whatever the batch boundaries.
    """
    from lastmile.sources.tables import Tables

    t = Tables(spark, sf_dir)
    # A file stream watches a folder or a pattern: this one matches the table's name alone, be it
    # one file or a folder of files.
    lineitem = spark.readStream.schema(t.raw("lineitem").schema).parquet(f"{t.sf_dir}/lineitem.parque[t]")
    work = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-timeline-{uuid.uuid4().hex}"
    start_timeline_stream(t.events_from(lineitem), f"{work}/versions", f"{work}/checkpoint").awaitTermination()
    return timeline_from_versions(spark, f"{work}/versions")
