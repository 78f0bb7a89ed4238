"""Interval, as-of and effective-dated joins without Cartesian products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 86400


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], at: str, start: str, end: str, *, how: str = "inner", bucket: int = BUCKET) -> DataFrame:
    """Points within half-open spans [start, end) of the same entity.

    Spans are spread over the time buckets they cover, so that the join is an equi-join on (entity, bucket) with the range
    as a further condition. Spans without bounds or not ending after their start match nothing. With ``how`` "left",
    spans are the left side and all are kept.
    """
    last = F.floor((F.col(end) - 1) / bucket)
    buckets = F.when(F.col(end) > F.col(start), F.sequence(F.floor(F.col(start) / bucket), last)).otherwise(F.array(F.lit(None).cast("bigint")))
    wide = spans.withColumn("__b", F.explode_outer(buckets))
    p = points.withColumn("__b", F.floor(F.col(at) / bucket))
    if how == "inner":
        return p.join(wide, [*by, "__b"]).filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("__b")
    s, q = wide.alias("s"), p.alias("q")
    on = (F.col("s.__b") == F.col("q.__b")) & (F.col(f"q.{at}") >= F.col(f"s.{start}")) & (F.col(f"q.{at}") < F.col(f"s.{end}"))
    for c in by:
        on = on & (F.col(f"s.{c}") == F.col(f"q.{c}"))
    return s.join(q, on, "left").select("s.*", *[F.col(f"q.{c}") for c in points.columns if c not in by]).drop("__b")


def as_of(points: DataFrame, states: DataFrame, by: list[str], at: str, since: str, values: list[str], *, shard: int = 7 * BUCKET) -> DataFrame:
    """Each point with the values of the latest state of its entity that began at or before it (null if there is none).

    Points and states are sorted together within time shards, and no pairs are made; what earlier shards end with is
    carried in by a scan over one row a shard. Of states that begin together the greatest values count. Points without
    entity or time get nulls.
    """
    state = F.struct(*[F.col(v) for v in values])
    kind = states.select(state.alias("s")).schema[0].dataType
    p = points.withColumns({"__t": F.col(at), "__k": F.lit(1), "__s": F.lit(None).cast(kind)})
    s = states.dropna(subset=[*by, since]).groupBy(*by, F.col(since).alias("__t")).agg(F.max(state).alias("__s")).withColumn("__k", F.lit(0))
    both = p.unionByName(s, allowMissingColumns=True).withColumn("__b", F.floor(F.col("__t") / shard))
    w = Window.partitionBy(*by, "__b").orderBy("__t", "__k").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__s", F.last("__s", ignorenulls=True).over(w)).filter("__k = 1")
    ends = both.select(*by, "__b", "__t", "__k", "__s").groupBy(*by, "__b").agg(F.max(F.when(F.col("__k") == 0, F.struct("__t", "__s")))["__s"].alias("__c"))
    earlier = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__c", F.last("__c", ignorenulls=True).over(earlier))
    joined = seen.join(carried, [*by, "__b"], "left").withColumn("__s", F.coalesce("__s", "__c"))
    return joined.select(*points.columns, *[F.col("__s")[v].alias(v) for v in values])


#: Days that facts and dated values are brought together by.
DATED_SHARD = 366


def effective(facts: DataFrame, profile: DataFrame, by: list[str], field: str, day: str, *, effective_from="effective_from", effective_to="effective_to") -> DataFrame:
    """Facts with the value of ``field`` in their subject's profile in force on ``day`` (from <= day <= to, open-ended without ``to``), null if none.

    ``profile`` has ``by``, field, value and the days it holds from and to. Entries of a field of a subject don't overlap
    (``profile.checked`` refuses them); were they to, the one that begins last counts. An as-of join: facts are brought
    together with the entries by subject and year, and no pairs are made.
    """
    p = profile.filter(F.col("field") == field).select(*by, F.col("value").alias("__value"), F.col(effective_from).cast("bigint").alias("__from"), F.col(effective_to).cast("bigint").alias("__until"))
    found = as_of(facts, p, by, day, "__from", ["__value", "__until"], shard=DATED_SHARD)
    return found.withColumn(field, F.when(F.col("__until").isNull() | (F.col(day) <= F.col("__until")), F.col("__value"))).drop("__value", "__until")
