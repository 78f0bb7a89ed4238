"""Streams of raw records through the batch functions.

Readings arrive late and repeatedly, so a micro-batch is normalized by the batch rules and merged by key; windowed
counts use a watermark that is as long as the overlap of the incremental batch runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.store import OVERLAP_HOURS, Store

LATENESS = f"{OVERLAP_HOURS} hours"


def read_raw(spark: SparkSession, folder: str, schema: str, *, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def normalize_into(raw: DataFrame, store: Store, name: str, rule: Callable[[DataFrame], DataFrame], key: list[str], checkpoint: str, *, part: str) -> StreamingQuery:
    """Normalize each micro-batch and merge it into a table kept in parts; replays of a batch change nothing.

    ``part`` is a column that a key never changes and that rows arriving together share (a local date, say): only the
    parts that a batch's rows fall in are rewritten.
    """

    def merge(batch: DataFrame, _: int) -> None:
        new = rule(batch).dropDuplicates(key).persist()
        try:
            store.merge_parts(name, new, key, part)
        finally:
            new.unpersist()

    return raw.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_rates(samples: DataFrame, *, entity: str = "sid", at: str = "ts", value: str = "bpm", width: str = "10 minutes", lateness: str = LATENESS) -> DataFrame:
    """Count, mean and range of readings in event-time windows; readings later than the watermark are left out.

    ``at`` is epoch seconds. Repeated deliveries (same entity, instant and value) within the watermark count once.
    """
    timed = samples.withColumn("event_time", F.timestamp_seconds(F.col(at))).withWatermark("event_time", lateness)
    once = timed.dropDuplicatesWithinWatermark([entity, "event_time", value])
    return once.groupBy(entity, F.window("event_time", width).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("lowest"), F.max(value).alias("highest")).select(entity, F.col("w.start").alias("start"), "n", "mean", "lowest", "highest")
