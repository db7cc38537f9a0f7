"""Structured Streaming beside the batch engine: feeds merged as they arrive, and windows over events with a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from transitnet.operators.patterns import merge
from transitnet.store import Store


def merge_feeds(spark: SparkSession, drops: str, schema: StructType, store: Store, table: str, key: str, version: Callable[[DataFrame, int], str], checkpoint: str) -> StreamingQuery:
    """Each micro-batch of files of rows becomes one merge into the table; a batch that is repeated merges to the same rows."""
    def one(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            rows = batch.dropDuplicates([key])
            store.commit({table: merge(store.read(table), rows, version(batch, epoch), key)})

    stream = spark.readStream.schema(schema).parquet(drops)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def republished_once(trips: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """The first of rows that repeat a key within the watermark."""
    return trips.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed(events: DataFrame, at: str, width: str, slide: str | None, late: str, by: list[str], **aggregates) -> DataFrame:
    """Aggregates by tumbling or sliding window; rows later than the watermark are dropped."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    return events.withWatermark(at, late).groupBy(window, *by).agg(*(a.alias(n) for n, a in aggregates.items()))


def sessions(events: DataFrame, at: str, gap: str, late: str, by: list[str], **aggregates) -> DataFrame:
    """Aggregates by session: runs of a key's events with gaps shorter than ``gap``."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), *by).agg(*(a.alias(n) for n, a in aggregates.items()))
