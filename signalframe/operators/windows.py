"""Calendar windows, islands and ordered folds over short arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar(by: list[str], day: str, first: int, last: int) -> Window:
    """Rows of the same entity whose day number is within [day + first, day + last]."""
    return Window.partitionBy(*by).orderBy(day).rangeBetween(first, last)


def before(by: list[str], *order: str) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def series_in(window: Window, day: str, value: str) -> Column:
    """The (day, value) pairs of a window by day; null values are no observations."""
    return F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(day).alias("d"), F.col(value).cast("double").alias("v")))).over(window))


SHARD_SECONDS = 7 * 86400


def with_previous(df: DataFrame, by: list[str], at: str, *, shard: int = SHARD_SECONDS, out: str = "previous") -> DataFrame:
    """Add the ``at`` of the row before in the entity's order (null for its first row); ties are repeated instants.

    Rows are ordered within time shards; a shard's first row takes the last ``at`` of the shard before, from a scan over
    one row a shard. So a busy entity is split over as many tasks as it has shards. Also adds ``__shard``.
    """
    s = df.withColumn("__shard", F.floor(F.col(at) / shard))
    ends = s.groupBy(*by, "__shard").agg(F.max(at).alias("__end")).withColumn("__end", F.lag("__end").over(Window.partitionBy(*by).orderBy("__shard")))
    inner = F.lag(at).over(Window.partitionBy(*by, "__shard").orderBy(at))
    return s.withColumn(out, inner).join(ends, [*by, "__shard"]).withColumn(out, F.coalesce(out, "__end")).drop("__end")


def with_next(df: DataFrame, by: list[str], at: str, order: list[str], *, shard: int = SHARD_SECONDS, out: str = "following") -> DataFrame:
    """Add the ``at`` of the row after in the entity's order (``order`` begins with ``at``), null for its last row.

    As ``with_previous``: rows are ordered within time shards, a shard's last row takes the first ``at`` of the shard after.
    """
    s = df.withColumn("__shard", F.floor(F.col(at) / shard))
    firsts = s.groupBy(*by, "__shard").agg(F.min(at).alias("__first")).withColumn("__first", F.lead("__first").over(Window.partitionBy(*by).orderBy("__shard")))
    inner = F.lead(at).over(Window.partitionBy(*by, "__shard").orderBy(*order))
    return s.withColumn(out, inner).join(firsts, [*by, "__shard"]).withColumn(out, F.coalesce(out, "__first")).drop("__first", "__shard")


def trailing_sum(df: DataFrame, by: list[str], at: str, value: str, width: int, *, shard: int = SHARD_SECONDS, out: str = "total") -> DataFrame:
    """(by..., at, out): the sum of ``value`` over the rows of the last ``width`` units up to each row.

    Rows near the end of a time shard go to the next one too, so that each shard is summed alone; ``width`` is at most ``shard``.
    """
    if width > shard:
        raise ValueError("the width must not exceed the shard")
    own = F.floor(F.col(at) / shard)
    s = df.select(*by, at, value, own.alias("__own"), F.explode(F.when(F.col(at) - own * shard > shard - width, F.array(own, own + 1)).otherwise(F.array(own))).alias("__shard"))
    total = F.sum(value).over(Window.partitionBy(*by, "__shard").orderBy(at).rangeBetween(-(width - 1), 0))
    return s.withColumn(out, total).filter("__own = __shard").select(*by, at, out)


def runs(df: DataFrame, by: list[str], at: str, low: int, high: int, *, shard: int = SHARD_SECONDS) -> DataFrame:
    """Label runs in which each step from the row before is within [low, high]: ``run`` is the running number per entity.

    A step outside (also 0, if ``low`` is 1) starts a new run. Numbers go on over time shards by a prefix scan of the
    starts in each. Rows without ``at`` or entity are left out.
    """
    s = with_previous(df.dropna(subset=[*by, at]), by, at, shard=shard).withColumn("__starts", F.when((F.col(at) - F.col("previous")).between(low, high), 0).otherwise(1))
    earlier = Window.partitionBy(*by).orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    before_ = s.groupBy(*by, "__shard").agg(F.sum("__starts").alias("__n")).withColumn("__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    # of one instant the row that starts a run is last: the window's order must be the same as that of the steps
    inside = F.sum("__starts").over(Window.partitionBy(*by, "__shard").orderBy(at, F.coalesce(F.col("previous"), F.lit(-(1 << 62)))).rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("run", inside).join(before_, [*by, "__shard"]).withColumn("run", F.col("run") + F.col("__n")).drop("__starts", "__n", "__shard", "previous")


def top_one(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """The first row of each group in a total order (rank-limited before the shuffle)."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__n = 1").drop("__n")


def max_gap(pairs: Column) -> Column:
    """Largest step between neighbouring days of a sorted array of (d, v); null with fewer than two."""
    days = F.transform(pairs, lambda p: p["d"])
    steps = F.transform(F.sequence(F.lit(1), F.size(days) - 1), lambda i: F.element_at(days, (i + 1).cast("int")) - F.element_at(days, i.cast("int")))
    return F.when(F.size(days) > 1, F.array_max(steps))
