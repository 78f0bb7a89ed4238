"""Mixing sources to target shares of tokens.

Documents get hash-random keys; within a source they are ordered by key in ranges, the token counts of the ranges are
summed and scanned, and the source is cut at its exact budget: whole ranges below the cut, the documents of the one
range that the cut falls in by their own prefix sums. No range is ever gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of hash keys in a source: 2 ** RANGE_BITS. The table of range sums has at most so many rows a source.
RANGE_BITS = 12


def normal_source(column):
    """A source's name without regard to letter case and spaces around it."""
    return F.lower(F.trim(column))


def budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row for each target: what the source has, may give, and must give.

    The total is the largest that lets every source with documents have its share within its repeats (or
    ``total_tokens``, if that is less). Sources without documents get nothing; the others' shares are scaled to sum to 1.
    Targets whose share is null or not positive get no tokens. One row a target, however many documents there are.
    """
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("available_documents"))
    t = targets.groupBy(normal_source(F.col("source")).alias("source")).agg(F.sum(F.greatest(F.col("target_share"), F.lit(0.0))).alias("target_share"), F.max(F.greatest(F.col("max_repeats"), F.lit(0))).alias("max_repeats"))
    t = t.join(have, "source", "left").fillna(0, ["available_tokens", "available_documents", "target_share", "max_repeats"])
    everything = Window.partitionBy(F.lit(0))
    able = (F.col("available_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    t = t.withColumn("scaled_share", F.when(able, F.col("target_share")).otherwise(0.0)).withColumn("scaled_share", F.try_divide("scaled_share", F.sum("scaled_share").over(everything)))
    most = F.min(F.when(able, F.floor(F.col("available_tokens") * F.col("max_repeats") / F.col("scaled_share")))).over(everything)
    t = t.withColumn("total_tokens", F.least(most, F.lit(total_tokens)) if total_tokens is not None else most)
    t = t.withColumn("budget_tokens", F.coalesce(F.least(F.floor(F.col("total_tokens") * F.col("scaled_share")), F.col("available_tokens") * F.col("max_repeats")), F.lit(0)))
    return t.withColumn("epochs", F.coalesce(F.expr("try_divide(budget_tokens - budget_tokens % greatest(available_tokens, 1), available_tokens)"), F.lit(0)).cast("bigint")).withColumn("rest_tokens", F.col("budget_tokens") - F.col("epochs") * F.col("available_tokens"))


def mix(sized: DataFrame, targets: DataFrame, *, seed: int = 0, total_tokens: int | None = None, range_bits: int = RANGE_BITS) -> DataFrame:
    """(doc_id, source, n_tokens, uses) of the documents in the mixed corpus.

    ``sized`` has doc_id, source and n_tokens (read several times: pass a materialized one). Every document of a source is
    used ``epochs`` times, and once more in the order of the hash keys up to the rest of the budget; the document in
    which the cut falls is taken if at least half of it fits. Sources without a target, null sources and documents
    without tokens aren't used. Ties of keys are ordered by doc_id.
    """
    key = F.xxhash64(F.lit(seed), "doc_id")
    docs = sized.select("doc_id", normal_source(F.col("source")).alias("source"), "n_tokens").filter("source is not null and n_tokens > 0").select("*", key.alias("key"), F.shiftright(key, 64 - range_bits).alias("range"))
    b = budgets(docs, targets, total_tokens).select("source", "epochs", "rest_tokens", F.col("max_repeats").cast("bigint").alias("max_repeats")).filter("epochs > 0 or rest_tokens > 0")
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = docs.groupBy("source", "range").agg(F.sum("n_tokens").alias("range_tokens")).withColumn("before", F.coalesce(F.sum("range_tokens").over(upto), F.lit(0))).join(b, "source")
    ranges = ranges.withColumn("side", F.when(F.col("before") + F.col("range_tokens") <= F.col("rest_tokens"), 1).when(F.col("before") >= F.col("rest_tokens"), -1).otherwise(0))
    placed = docs.join(ranges.drop("range_tokens"), ["source", "range"])
    whole = placed.filter("side <> 0").withColumn("uses", F.col("epochs") + F.when(F.col("side") == 1, 1).otherwise(0))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    cut = placed.filter("side = 0").withColumn("room", F.col("rest_tokens") - at).withColumn("uses", F.col("epochs") + F.when((F.col("room") * 2 >= F.col("n_tokens")) & (F.col("room") > 0), 1).otherwise(0))
    columns = ("doc_id", "source", "n_tokens", F.least("uses", "max_repeats").alias("uses"))
    return whole.select(*columns).unionByName(cut.select(*columns)).filter("uses > 0")


def shares(sized: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """One row for each target source: its share, what it has, its budget, and the documents, tokens and share reached."""
    docs = sized.select("doc_id", normal_source(F.col("source")).alias("source"), "n_tokens").filter("source is not null and n_tokens > 0")
    reached = mix(sized, targets, **options).groupBy("source").agg(F.count("*").alias("documents"), F.sum("uses").alias("uses"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most_uses"))
    b = budgets(docs, targets, options.get("total_tokens"))
    out = b.join(reached, "source", "left").fillna(0, ["documents", "uses", "tokens", "most_uses"])
    return out.select(
        "source", "target_share", "scaled_share", F.col("max_repeats").cast("bigint").alias("max_repeats"), "available_documents", "available_tokens", "budget_tokens",
        "documents", "uses", "most_uses", "tokens", F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(Window.partitionBy(F.lit(0)))), F.lit(0.0)).alias("reached_share"),
    )
