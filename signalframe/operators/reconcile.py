"""Reconciling copies of records from several sources: versions, missing records, selection, conflicts, roles, change log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Which source a record is taken from: by the ending of its key, first ``preferred``, then ``secondary``, then others.

    With ``exclude_unresolved`` a record whose active copies disagree in value, time or date is not selected at all.
    """

    name: str
    preferred: str
    secondary: str
    exclude_unresolved: bool = False


#: The policies of the contract.
POLICIES = {p.name: p for p in (Policy("ru_compat", ":region:ru", ":region:cn"), Policy("cn_review", ":region:cn", ":region:ru"), Policy("unresolved_exclude", ":region:ru", ":region:cn", True))}


def one_per_generation(records: DataFrame, generations: DataFrame) -> DataFrame:
    """One row for each copy and generation, the last seen; with ``scanned`` of the generation. Combined before the shuffle."""
    seen = F.col("last_seen_at").try_cast("timestamp")
    fields = ("logical_record_id", "source_db_id", "source_timestamp", "local_date", "value_json", "status", "content")
    r = records.withColumn("seen", seen).groupBy("physical_record_id", "last_seen_generation").agg(F.max(F.struct("seen", *fields)).alias("r"))
    g = generations.select(F.col("generation_id").alias("last_seen_generation"), F.col("scanned_at").alias("scanned"))
    return r.join(g, "last_seen_generation").select("physical_record_id", "last_seen_generation", "scanned", *[F.col("r")[f].alias(f) for f in fields])


def versions(seen: DataFrame) -> DataFrame:
    """History of each copy: a version for each run of the same content and status, open at the end.

    ``seen`` has one row for each copy and generation; a copy has no more rows than there are generations.
    """
    w = Window.partitionBy("physical_record_id").orderBy("scanned")
    changed = ~(F.lag("content").over(w).eqNullSafe(F.col("content")) & F.lag("status").over(w).eqNullSafe(F.col("status")))
    starts = seen.withColumn("changed", changed | F.lag("scanned").over(w).isNull()).filter("changed")
    return starts.select("physical_record_id", "content", "status", F.col("scanned").alias("active_from"), F.lead("scanned").over(w).alias("active_to"))


def missing(seen: DataFrame) -> DataFrame:
    """Copies known from earlier snapshots of their source but absent in its last one: they become MISSING, never deleted."""
    last = seen.groupBy("source_db_id").agg(F.max("scanned").alias("last_scan"))
    copies = seen.groupBy("physical_record_id", "source_db_id").agg(F.max(F.struct("scanned", "status")).alias("x"))
    return copies.join(last, "source_db_id").filter((F.col("x.scanned") < F.col("last_scan")) & (F.col("x.status") != "MISSING")).select("physical_record_id", "source_db_id", F.col("x.status").alias("last_status"))


def current(seen: DataFrame) -> DataFrame:
    """State of each copy: its row of the latest generation."""
    fields = [c for c in seen.columns if c not in ("physical_record_id", "scanned")]
    return seen.groupBy("physical_record_id").agg(F.max(F.struct("scanned", *fields)).alias("r")).select("physical_record_id", "r.*")


def select_canonical(copies: DataFrame, sources: DataFrame, policy: Policy) -> DataFrame:
    """One row for each record: the copy selected among its active ones, and the kind of conflict between them.

    NONE, DUPLICATE_EQUAL (several of the same content), EQUIVALENT_PHYSIOLOGY_METADATA_DIFF (contents differ, but not
    value, time or date), UNRESOLVED_SELECTED_FOR_COMPATIBILITY, UNRESOLVED_EXCLUDED. Aggregated with partial results, so
    a record with very many copies costs no more than its rows.
    """
    c = copies.join(sources.select("source_db_id", "source_key"), "source_db_id", "left")
    region = F.when(F.endswith("source_key", F.lit(policy.preferred)), 0).when(F.endswith("source_key", F.lit(policy.secondary)), 1).otherwise(2)
    live = F.col("status") == "ACTIVE"
    value = F.struct("value_json", "source_timestamp", "local_date")
    g = c.groupBy("logical_record_id").agg(
        F.min(F.when(live, F.struct(region.alias("region"), "source_key", "physical_record_id"))).alias("best"), F.count_if(live).alias("active_copies"),
        F.count_distinct(F.when(live, F.col("content"))).alias("contents"), F.count_distinct(F.when(live, value)).alias("meanings"),
    )
    unresolved = F.col("meanings") > 1
    chosen = F.when(~(unresolved & F.lit(policy.exclude_unresolved)), F.col("best.physical_record_id"))
    state = (
        F.when(unresolved & chosen.isNull(), "UNRESOLVED_EXCLUDED").when(unresolved, "UNRESOLVED_SELECTED_FOR_COMPATIBILITY").when(F.col("contents") > 1, "EQUIVALENT_PHYSIOLOGY_METADATA_DIFF")
        .when(F.col("active_copies") > 1, "DUPLICATE_EQUAL").otherwise("NONE")
    )
    return g.select("logical_record_id", chosen.alias("selected_id"), "active_copies", "contents", "meanings", state.alias("conflict"))


def roles(copies: DataFrame, selection: DataFrame) -> DataFrame:
    """What each copy is to its record: the primary, an alternative, a duplicate, a tombstone or missing."""
    live = F.col("status") == "ACTIVE"
    role = (
        F.when(F.col("physical_record_id") == F.col("selected_id"), "PRIMARY").when(live & (F.col("meanings") > 1), "CONFLICT_ALTERNATIVE").when(live & (F.col("contents") > 1), "DUPLICATE_EQUIVALENT")
        .when(live, "DUPLICATE_EQUAL").when(F.col("status") == "TOMBSTONE", "TOMBSTONE_SOURCE").otherwise("SOURCE_MISSING")
    )
    return copies.join(selection, "logical_record_id").select("logical_record_id", "physical_record_id", role.alias("role"))


def change_log(before: DataFrame, after: DataFrame) -> DataFrame:
    """INSERT, DELETE, UPDATE, CONFLICT_CHANGE between two selections (logical_record_id, selected_id, content, local_date, conflict).

    A record that isn't selected doesn't count as there. An empty ``before`` is the initial build: its inserts aren't logged.
    """
    b, a = (x.select("logical_record_id", *[F.col(c).alias(f"{p}_{c}") for c in ("selected_id", "content", "local_date", "conflict")]) for x, p in ((before, "old"), (after, "new")))
    j = b.join(a, "logical_record_id", "full_outer")
    kind = (
        F.when(F.col("old_selected_id").isNull() & F.col("new_selected_id").isNotNull(), "INSERT").when(F.col("old_selected_id").isNotNull() & F.col("new_selected_id").isNull(), "DELETE")
        .when(F.col("old_selected_id").isNull(), F.lit(None).cast("string")).when(~F.col("old_content").eqNullSafe(F.col("new_content")) | ~F.col("old_local_date").eqNullSafe(F.col("new_local_date")), "UPDATE")
        .when(~F.col("old_conflict").eqNullSafe(F.col("new_conflict")), "CONFLICT_CHANGE")
    )
    return j.withColumn("change", kind).filter("change is not null").select("logical_record_id", "change", F.col("old_local_date").alias("old_date"), F.col("new_local_date").alias("new_date"))


def content_of(content_hash: Column) -> Column:
    """Lower-case hex of a hash in its usual spellings."""
    return F.lower(F.regexp_replace(F.trim(content_hash), r"^(0[xX]|[xX]')|'$", ""))


def mirror(new: DataFrame, old: DataFrame, key: str, unchanged: list[str], imported: str, now: Column) -> DataFrame:
    """Rebuild of a table that keeps the import time of rows whose ``unchanged`` columns stayed the same."""
    o = old.select(key, *[F.col(c).alias(f"__{c}") for c in unchanged], F.col(imported).alias("__at"))
    same = F.lit(True)
    for c in unchanged:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return new.join(o, key, "left").withColumn(imported, F.when(same & F.col("__at").isNotNull(), F.col("__at")).otherwise(now)).drop("__at", *[f"__{c}" for c in unchanged])


def state_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Copies (physical_record_id, content, status) whose content or status isn't that of before, with those of before."""
    b = before.select("physical_record_id", F.col("content").alias("old_content"), F.col("status").alias("old_status"), F.lit(True).alias("__known"))
    j = now.select("physical_record_id", "content", "status").join(b, "physical_record_id", "left")
    same = F.col("__known").isNotNull() & F.col("content").eqNullSafe(F.col("old_content")) & F.col("status").eqNullSafe(F.col("old_status"))
    return j.filter(~same).drop("__known")


def extend_history(history: DataFrame, changed: DataFrame, now: str) -> DataFrame:
    """The history with the open versions of changed copies closed at ``now``, and their new versions open from it."""
    marked = history.join(changed.select("physical_record_id", F.lit(True).alias("__changed")), "physical_record_id", "left")
    closed = marked.withColumn("active_to", F.when(F.col("active_to").isNull() & F.col("__changed"), F.lit(now)).otherwise(F.col("active_to"))).drop("__changed")
    opened = changed.select("physical_record_id", "content", "status", F.lit(now).alias("active_from"), F.lit(None).cast("string").alias("active_to"))
    return closed.unionByName(opened)


class Refused(RuntimeError):
    """Nothing is published: the input doesn't look like a complete, unambiguous set of sources."""


def check_sources(known: DataFrame, present: DataFrame) -> None:
    """Refuse if a known source is absent now, or if two files claim one key (source_key, relative_path)."""
    absent = known.select("source_key").distinct().join(present.select("source_key").distinct(), "source_key", "left_anti").limit(5).collect()
    twice = present.groupBy("source_key").agg(F.count_distinct("relative_path").alias("n")).filter("n > 1").limit(5).collect()
    if absent or twice:
        raise Refused(f"absent: {[r[0] for r in absent]}; ambiguous: {[r[0] for r in twice]}")


def archived_blobs(blobs: DataFrame, changed: DataFrame, archive: DataFrame) -> DataFrame:
    """The archive with the blobs of changed records added, each content once."""
    key = ["physical_record_id", "column_name", "sha256"]
    fresh = blobs.join(changed.select("physical_record_id").distinct(), "physical_record_id", "left_semi").dropDuplicates(key)
    return archive.unionByName(fresh.join(archive.select(*key), key, "left_anti"))
