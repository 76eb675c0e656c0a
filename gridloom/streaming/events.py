"""Streams, an extension: deduplicated events under a watermark, tumbling counts, and upserts of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.sources.keyed_table import KeyedTable


def _zoned(events: DataFrame, time: str) -> DataFrame:
    """Watermarks need a timestamp with a time zone: that of the session."""
    return events.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(events: DataFrame, key: str = "event_id", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each key once; state is dropped as the watermark passes."""
    return _zoned(events, time).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def tumbling(events: DataFrame, by: str = "event_type", time: str = "ts", width: str = "1 day", delay: str | None = "1 hour") -> DataFrame:
    """Count and sum by window and type. The same function serves a batch, where the watermark does nothing."""
    timed = _zoned(events, time).withWatermark(time, delay) if delay and events.isStreaming else events
    return timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value_sum")).select(F.col("w.start").alias("window_start"), by, "n", "value_sum")


def upsert_stream(events: DataFrame, path: str, keys: list[str], seq: str, checkpoint: str, buckets: int = 32) -> StreamingQuery:
    """Keep a table of the last row of each key (``KeyedTable(spark, path, keys, seq)`` reads it): every micro-batch rewrites
    the buckets of its own keys. A batch that is replayed is left alone."""
    table = KeyedTable(events.sparkSession, path, keys, seq, buckets)

    def merge(batch: DataFrame, epoch: int) -> None:
        table.merge(batch, epoch, writer=checkpoint)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
