"""Irregular readings onto a regular grid, and rolling totals over calendar days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grid_shards(df: DataFrame, entity: str, seconds: Column, step: int, shard: int) -> DataFrame:
    """One row for each entity and time shard with a reading: which slots are taken, and the neighbouring shards with readings.

    (e, shard, taken: sorted slot numbers within the shard, before: previous shard with readings, after: next one.)
    Slots are collected as sets before the shuffle, so a shard never holds more than ``shard / step`` of them, however
    many readings fall in. The carry of ``before`` and ``after`` is a scan over one row a shard.
    """
    per = shard // step
    slot = F.floor(seconds / step)
    w = Window.partitionBy("e").orderBy("shard")
    return (
        df.select(F.col(entity).alias("e"), slot.alias("slot"))
        .filter("e is not null and slot is not null")
        .select("e", F.floor(F.col("slot") / per).alias("shard"), F.pmod(F.col("slot"), F.lit(per)).cast("int").alias("k"))
        .groupBy("e", "shard")
        .agg(F.sort_array(F.collect_set("k")).alias("taken"))
        .withColumn("before", F.lag("shard").over(w))
        .withColumn("after", F.lead("shard").over(w))
    )


def empty_slots(df: DataFrame, entity: str, seconds: Column, *, step: int = 600, shard: int = 86400) -> DataFrame:
    """(entity, slot_start_utc) of the slots without a reading, from the slot of the entity's first to that of its last reading.

    Slots start at multiples of ``step`` seconds of epoch time; ``shard`` is a multiple of ``step``. Readings without
    entity or instant don't count. Every shard is filled alone: its own empty slots, and the whole shards up to the next
    one with readings.
    """
    per = shard // step
    shards = grid_shards(df, entity, seconds, step, shard)
    low = F.when(F.col("before").isNull(), F.array_min("taken")).otherwise(0)
    high = F.when(F.col("after").isNull(), F.array_max("taken")).otherwise(per - 1)
    own = F.array_except(F.sequence(low, high), "taken")
    whole = F.when(F.col("after") > F.col("shard") + 1, F.sequence(F.col("shard") + 1, F.col("after") - 1)).otherwise(F.array().cast("array<bigint>"))
    pieces = shards.select("e", "shard", own.alias("own"), F.explode(F.concat(F.array("shard"), whole)).alias("at"))
    slots = F.when(F.col("at") == F.col("shard"), F.col("own")).otherwise(F.sequence(F.lit(0), F.lit(per - 1)))
    return pieces.select("e", "at", F.explode(slots).alias("k")).select(F.col("e").alias(entity), ((F.col("at") * per + F.col("k")) * step).alias("slot_start_utc"))


def regular_series(df: DataFrame, entity: str, seconds: Column, value: str, *, step: int = 600, shard: int = 86400) -> DataFrame:
    """(entity, slot_start_utc, n, mean_value, empty, carried_value): every slot from the first to the last reading.

    A taken slot has the number and mean of its readings; an empty one is marked, with the mean of the last taken slot
    before it carried in ``carried_value`` (in taken slots the slot's own mean). Null values are no readings. Shards are
    summarized by their taken slots (at most ``shard / step``) and filled alone; the last mean of the shard before and the
    number of the next are carried by a scan over one row a shard.
    """
    per = shard // step
    taken = (
        df.select(F.col(entity).alias("e"), F.floor(seconds / step).alias("slot"), F.col(value).alias("v"))
        .dropna()
        .groupBy("e", "slot")
        .agg(F.count("*").alias("n"), F.avg("v").alias("m"))
        .groupBy("e", F.floor(F.col("slot") / per).alias("shard"))
        .agg(F.array_sort(F.collect_list(F.struct(F.pmod("slot", F.lit(per)).cast("int").alias("k"), "n", "m"))).alias("t"))
    )
    w = Window.partitionBy("e").orderBy("shard")
    shards = taken.withColumns({"carry": F.lag(F.element_at("t", -1)["m"]).over(w), "after": F.lead("shard").over(w), "last": F.element_at("t", -1)["m"]})
    # of each shard: up to its first reading, from each reading to the next, and the whole shards up to the next one with readings
    piece = lambda at, k, until, n, m, carried: F.struct(at.alias("shard"), k.cast("int").alias("k"), until.cast("int").alias("until"), n.cast("bigint").alias("n"), m.cast("double").alias("m"), carried.cast("double").alias("carried"))
    nothing, here = F.lit(None), F.col("shard")
    top = F.when(F.col("after").isNull(), F.element_at("t", -1)["k"] + 1).otherwise(per)
    head = F.when(F.col("carry").isNotNull() & (F.col("t")[0]["k"] > 0), F.array(piece(here, F.lit(0), F.col("t")[0]["k"], F.lit(0), nothing, F.col("carry")))).otherwise(F.array())
    own = F.transform("t", lambda x, i: piece(here, x["k"], F.coalesce(F.get("t", i + 1)["k"], top), x["n"], x["m"], x["m"]))
    whole = F.when(F.col("after") > here + 1, F.transform(F.sequence(here + 1, F.col("after") - 1), lambda d: piece(d, F.lit(0), F.lit(per), F.lit(0), nothing, F.col("last")))).otherwise(F.array())
    pieces = shards.select("e", F.explode(F.concat(head, own, whole)).alias("p")).select("e", "p.*").withColumn("at", F.explode(F.sequence("k", F.col("until") - 1)))
    reading = (F.col("at") == F.col("k")) & (F.col("n") > 0)
    return pieces.select(
        F.col("e").alias(entity), ((F.col("shard") * per + F.col("at")) * step).alias("slot_start_utc"), F.when(reading, F.col("n")).otherwise(0).alias("n"), F.when(reading, F.col("m")).alias("mean_value"),
        (~reading).alias("empty"), F.col("carried").alias("carried_value"),
    )


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date")).cast("bigint")


def daily_values(df: DataFrame, entity: str, date: str, version: str, values: dict[str, Column]) -> DataFrame:
    """(e, day, one column a value): of each value of an entity and day the one of the latest version that has one (ties: the greatest).

    Days are integer day numbers; unreadable dates don't count. Aggregated before the shuffle, so repeats cost nothing.
    """
    day = day_number(F.try_to_date(F.substring(F.col(date), 1, 10), "yyyy-MM-dd"))
    picked = [F.max(F.when(v.isNotNull(), F.struct(F.col(version).alias("at"), v.alias("v"))))["v"].alias(name) for name, v in values.items()]
    return df.withColumn("__e", F.col(entity)).withColumn("__day", day).filter("__e is not null and __day is not null").groupBy(F.col("__e").alias("e"), F.col("__day").alias("day")).agg(*picked)


def with_calendar(days: DataFrame, values: list[str]) -> DataFrame:
    """Add a row for every day between an entity's first and last: values null there. The calendar bounds an entity's rows."""
    w = Window.partitionBy("e").orderBy("day")
    until = F.coalesce(F.lead("day").over(w), F.col("day") + 1)
    filled = days.withColumn("until", until).withColumn("at", F.explode(F.sequence(F.col("day"), F.col("until") - 1)))
    return filled.select("e", F.col("at").alias("day"), *[F.when(F.col("at") == F.col("day"), F.col(v)).alias(v) for v in values])


def trailing(days: int) -> Window:
    """The day and the ``days - 1`` before it, of one entity."""
    return Window.partitionBy("e").orderBy("day").rangeBetween(-(days - 1), 0)
