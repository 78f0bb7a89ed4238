"""Overlapping intervals of an entity: continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_SECONDS = 7 * 86400


def latest_version(df: DataFrame, key: str, version: str, *columns: str) -> DataFrame:
    """One row for each key: that with the greatest version (ties: the greatest values, column by column; null versions first)."""
    return df.groupBy(key).agg(F.max(F.struct(version, *columns)).alias("__v")).select(key, *[F.col("__v")[c].alias(c) for c in columns])


def _carried(shards: DataFrame, value: str, out: str) -> DataFrame:
    """Prefix scan over the shards of an entity: the greatest value of all earlier shards. One row a shard, so the calendar bounds it."""
    return shards.withColumn(out, F.max(value).over(Window.partitionBy("e").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))).select("e", "shard", out)


def periods_and_gaps(df: DataFrame, entity: str, start: str, end: str, minor: Column, *, labels=("main", "nap", "gap"), shard_seconds: int = SHARD_SECONDS) -> DataFrame:
    """(entity, kind, start_utc, end_utc): the union of an entity's intervals as continuous periods, and the gaps between.

    Intervals that overlap or touch form one period, ``labels[1]`` if ``minor`` holds for all of them, else
    ``labels[0]``; ``labels[2]`` is the time from a period's end to the next one's start. Intervals without entity or
    bounds, or not ending after their start, don't count; a null ``minor`` counts as false.

    Intervals with one start are first merged (their union is one interval), which bounds the rows of an entity in a
    time shard by its seconds. Within a shard each start is compared with the running maximum of earlier ends; what
    earlier shards hold comes in through a prefix scan over one row a shard, so no task sees a whole entity.
    """
    base = (
        df.select(F.col(entity).alias("e"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("t"), F.coalesce(minor, F.lit(False)).cast("int").alias("minor"))
        .filter("e is not null and s is not null and t > s")
        .groupBy("e", "s")
        .agg(F.max("t").alias("t"), F.min("minor").alias("minor"))
        .withColumn("shard", F.floor(F.col("s") / shard_seconds))
    )
    before = Window.partitionBy("e", "shard").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("e", "shard").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    ends = _carried(base.groupBy("e", "shard").agg(F.max("t").alias("t")), "t", "end_before")
    flagged = (
        base.join(ends, ["e", "shard"])
        .withColumn("reach", F.greatest(F.max("t").over(before), "end_before"))
        .withColumn("opens", F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), F.col("s")))
        .withColumn("island", F.max("opens").over(upto))
    )
    opened = _carried(flagged.groupBy("e", "shard").agg(F.max("opens").alias("opens")), "opens", "open_before")
    merged = (
        flagged.join(opened, ["e", "shard"])
        .groupBy("e", F.coalesce("island", "open_before").alias("island"))
        .agg(F.max("t").alias("t"), F.min("minor").alias("minor"), F.max(F.when(F.col("opens").isNotNull(), F.col("reach"))).alias("reach"))
    )
    main, nap, gap = map(F.lit, labels)
    period = F.struct(F.when(F.col("minor") == 1, nap).otherwise(main).alias("kind"), F.col("island").alias("start_utc"), F.col("t").alias("end_utc"))
    hole = F.struct(gap.alias("kind"), F.col("reach").alias("start_utc"), F.col("island").alias("end_utc"))
    rows = F.when(F.col("reach").isNull(), F.array(period)).otherwise(F.array(period, hole))
    return merged.select(F.col("e").alias(entity), F.explode(rows).alias("r")).select(entity, "r.kind", "r.start_utc", "r.end_utc")
