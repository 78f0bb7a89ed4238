"""End-to-end runs over a store: exports to normalized tables, reconciliation of all copies, features and metrics.

Every run is logged RUNNING, then SUCCESS, SKIPPED or FAILED. Results are written aside first; tables, then the state,
become visible at the end, so that a failed run leaves everything as it was. The time of a run is a parameter.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import local_date, sleep_date
from ..functions.identity import source_key
from ..operators import reconcile as r
from ..operators.regular import day_number
from ..sources import databases as db
from ..sources.adapter import CAPABILITIES, TableSource
from . import features as f
from . import metric_table as t
from . import normalize as n
from .store import HORIZON_DAYS, OVERLAP_HOURS, Store, classify, cutoff, replace_children, unchanged, upsert

#: What a selection of copies is decided by.
CONFLICT_POLICY_VERSION = "priority-3"
#: Normalized tables: the rule of each, from raw records.
RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{k: (lambda raw, k=k: n.samples(raw, k)) for k in n.SAMPLES},
    "heart_rate_events": n.heart_rate_events, "heart_rate_event_samples": n.heart_rate_event_samples, "standing_intervals": n.standing_intervals, "sleep_sessions": n.sleep_sessions, "sleep_stages": n.sleep_stages,
    "workouts": lambda raw: n.workouts(raw, "sport"), "daily_cells": n.daily_cells, "derived_metrics": n.derived_metrics,
}
DIRTY = "sid string, day bigint"


def _logged(store: Store, kind: str, now: str, run: Callable[[str], dict]) -> dict:
    run_id = f"{kind}-{uuid.uuid4().hex}"
    with store.lock(kind):
        store.log_run(run_id, "RUNNING", now)
        try:
            result = run(run_id)
        except db.SourceBusy as e:
            store.log_run(run_id, "SKIPPED", now, now, str(e)[:500])
            return {"status": "SKIPPED", "reason": str(e)}
        except Exception as e:
            store.log_run(run_id, "FAILED", now, now, f"{type(e).__name__}: {e}"[:500])
            raise
        store.log_run(run_id, result["status"], now, now, json.dumps(result, sort_keys=True))
    return result


def _release(store: Store, staged: dict[str, str]) -> None:
    for name, version in staged.items():
        store.release(name, version)


def changed_days(raw: DataFrame, store: Store) -> DataFrame:
    """Days whose features changed records touch: theirs, the sleep dates of their sessions before and now, and the days beside them."""
    sessions = lambda x: x.select("sid", day_number(sleep_date(F.col("sleep_end_utc"), F.coalesce("utc_offset_seconds", F.lit(0)))).alias("day"))
    days = [raw.select("sid", day_number(local_date(F.col("time"), F.col("zone_offset"), F.col("time_zero"))).alias("day"))]
    days.append(sessions(n.sleep_sessions(raw)))
    for name in ("heart_rate", "spo2", "stress", "daily_cells"):
        days.append(RULES[name](raw).select("sid", day_number(F.col("local_date")).alias("day")))
        if store.has(name):
            days.append(store.table(name).join(raw.select("source_record_id").distinct(), "source_record_id", "left_semi").select("sid", day_number(F.col("local_date")).alias("day")))
    if store.has("sleep_sessions"):
        days.append(sessions(store.table("sleep_sessions").join(raw.select("source_record_id").distinct(), "source_record_id", "left_semi")))
    touched = reduce(DataFrame.unionByName, days).dropna()
    return touched.select("sid", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1)).alias("day")).distinct()


def normalize_changes(store: Store, raw: DataFrame) -> dict[str, str]:
    """Staged versions of all normalized tables, with what the given (changed) raw records give now; others stay."""
    live = raw.filter("deleted = 0")
    staged = {}
    for name, rule in RULES.items():
        new = rule(live)
        staged[name] = store.stage(name, replace_children(store.table(name, new.schema), new, raw, "source_record_id"))
    return staged


def daily_summary(store: Store) -> DataFrame:
    return n.pivoted(store.table("daily_cells"))


def _summaries(spark: SparkSession, store: Store) -> None:
    store.publish("daily_summary", daily_summary(store))


def ingest(spark: SparkSession, store: Store, root: str, work: str, *, now: str, force: bool = False, overlap_hours: int = OVERLAP_HOURS) -> dict:
    """Read what is new in the exports below ``root`` into the store; ``work`` is a folder that all executors see.

    A database is read if its quick fingerprint changed, from ``overlap_hours`` before the last time seen in it. Records
    are new, updated or unchanged by the hash of their content; only new and updated ones are normalized again.
    """

    def run(run_id: str) -> dict:
        prints = {x["relative_path"]: x.asDict() for x in db.fingerprints(db.discover(spark, root)).select("path", "relative_path", "quick").collect()}  # one row a database
        known = {} if force or not store.has("raw_records") else store.state().get("databases", {})
        fresh = [x for rel, x in prints.items() if known.get(rel, {}).get("quick") != x["quick"]]
        if not fresh:
            return {"status": "NO NEW SOURCE DATA"}
        since = {x["path"]: cutoff(last, overlap_hours) for x in fresh if (last := known.get(x["relative_path"], {}).get("last")) is not None}
        copies = db.snapshots(spark.createDataFrame([(x["path"], x["relative_path"]) for x in fresh], "path string, relative_path string"), work).collect()
        busy = [x["busy"] for x in copies if x["busy"]]
        if busy:
            raise db.SourceBusy("; ".join(busy))
        sources = spark.createDataFrame([(x["snapshot"], since.get(x["path"]), x["relative_path"]) for x in copies], "path string, cutoff bigint, relative_path string")
        columns = db.catalog(db.columns_of(sources))
        store.publish("source_table_catalog", upsert(store.table("source_table_catalog", "relative_path string, table_name string"), columns.join(sources.select("path", "relative_path"), "path").drop("path"), ["relative_path", "table_name"]))
        read = db.records(sources, columns).join(sources.select("path", "relative_path"), "path").drop("path")
        # of the copies of a record in several databases the last counts, in the order of their paths
        one = read.groupBy("source_record_id").agg(F.max_by(F.struct(*[c for c in read.columns if c != "source_record_id"]), F.struct("relative_path", "content")).alias("x")).select("source_record_id", "x.*")
        seen = store.publish("incoming", classify(one, store.table("raw_records", one.schema), ["source_record_id"], "content"))
        counts = {x["change"]: x["n"] for x in seen.groupBy("change").agg(F.count("*").alias("n")).collect()}
        last = {x["relative_path"]: x["last"] for x in store.table("incoming").groupBy("relative_path").agg(F.max("time").alias("last")).collect()}
        changes = seen.filter("change <> 'unchanged'").drop("change")
        raw = store.table("raw_records", changes.schema)
        staged = {"dirty_days": store.stage("dirty_days", store.table("dirty_days", DIRTY).unionByName(changed_days(changes, store)).distinct())}
        staged |= normalize_changes(store, changes)
        staged["raw_records"] = store.stage("raw_records", upsert(raw, changes, ["source_record_id"]))
        _release(store, staged)
        _summaries(spark, store)
        databases = known | {x["relative_path"]: {"quick": x["quick"], "last": max((v for v in (known.get(x["relative_path"], {}).get("last"), last.get(x["relative_path"])) if v is not None), default=None)} for x in fresh}
        store.update_state(databases=databases, last_ingest=run_id, warnings=warnings(store).count())
        return {"status": "SUCCESS", "databases": len(fresh), **{k: counts.get(k, 0) for k in ("new", "updated", "unchanged")}}

    return _logged(store, "ingest", now, run)


#: Limits of the values of normalized tables, and of their times (the last is 366 days after a run).
LIMITS = {"heart_rate": ("bpm", 25, 240), "spo2": ("value", 50, 100), "stress": ("value", 0, 100)}
EARLIEST = 946684800


def range_warnings(table: DataFrame, column: str, low: float, high: float, kind: str) -> DataFrame:
    """(source_record_id, warning) of values outside their limits."""
    return table.filter((F.col(column) < low) | (F.col(column) > high)).select("source_record_id", F.lit(kind).alias("warning")).distinct()


def warnings(store: Store, latest: int = 4102444800) -> DataFrame:
    """(source_record_id, warning): ranges of values and times, order of sessions and stages; each once a record."""
    found = [range_warnings(store.table(name), c, low, high, f"{name}_range") for name, (c, low, high) in LIMITS.items()]
    found += [range_warnings(store.table(name), c, EARLIEST, latest, "timestamp_range") for name, c in (("heart_rate", "timestamp_utc"), ("spo2", "timestamp_utc"), ("stress", "timestamp_utc"), ("sleep_sessions", "sleep_end_utc"))]
    s, g = store.table("sleep_sessions"), store.table("sleep_stages")
    found.append(s.filter("sleep_end_utc < sleep_start_utc").select("source_record_id", F.lit("sleep_order").alias("warning")))
    found.append(s.filter("duration_minutes < 0").select("source_record_id", F.lit("sleep_duration").alias("warning")))
    found.append(g.filter("end_timestamp_utc < start_timestamp_utc").select("source_record_id", F.lit("sleep_stage_order").alias("warning")))
    return reduce(DataFrame.unionByName, found).distinct()


def reconcile(spark: SparkSession, store: Store, root: str, work: str, *, now: str, policy: str = "ru_compat", full: bool = False) -> dict:
    """Scan every copy of every record, keep their history, select one copy for each record, and log what that changed.

    Nothing is published if a known source is absent, two files claim one key, or a source changed while all were read.
    """
    chosen = r.POLICIES[policy]

    def run(run_id: str) -> dict:
        found = db.fingerprints(db.discover(spark, root, skip_conflicts=True)).withColumn("source_key", source_key(F.col("relative_path")))
        before = {x["path"]: x.asDict() for x in found.collect()}  # one row a database
        quick = json.dumps(sorted((x["source_key"], x["quick"]) for x in before.values()))
        policy_version = f"{CONFLICT_POLICY_VERSION}:{policy}"
        state = store.state()
        if not full and store.has("physical_records") and unchanged(state.get("reconciled", {}), deep_at=state.get("reconciled", {}).get("deep_at"), now=now, quick=quick, policy=policy_version):
            return {"status": "NO NEW SOURCE DATA"}
        present = spark.createDataFrame([(x["source_key"], x["relative_path"]) for x in before.values()], "source_key string, relative_path string")
        r.check_sources(store.table("source_database_identities", present.schema), present)
        copies = db.snapshots(spark.createDataFrame([(p,) for p in before], "path string"), work).collect()
        if any(x["busy"] for x in copies):
            raise db.SourceBusy("; ".join(x["busy"] for x in copies if x["busy"]))
        sources = spark.createDataFrame([(x["snapshot"], None, before[x["path"]]["source_key"]) for x in copies], "path string, cutoff bigint, source_key string")
        read = db.records(sources, db.catalog(db.columns_of(sources))).join(sources.select("path", "source_key"), "path")
        seen = read.select(
            F.sha2(F.concat("source_key", F.lit("|"), "source_record_id"), 256).alias("physical_record_id"), F.col("source_record_id").alias("logical_record_id"), F.col("source_key").alias("source_db_id"), "source_table", "sid", "key",
            F.col("time").alias("source_timestamp"), "time_zero", "zone_offset", local_date(F.col("time"), F.col("zone_offset"), F.col("time_zero")).cast("string").alias("local_date"), F.col("value").alias("value_json"), "record_json",
            F.when(F.col("deleted") != 0, "TOMBSTONE").otherwise("ACTIVE").alias("status"), "content", "blobs",
        )
        staged = {"physical_scan": store.stage("physical_scan", seen)}
        after = {x["path"]: x["manifest"] for x in db.fingerprints(found.select("path", "relative_path")).collect()}
        if after != {p: x["manifest"] for p, x in before.items()}:
            raise db.SourceBusy("a source changed while the sources were read")
        scan = spark.read.parquet(f"{store.root}/physical_scan/{staged['physical_scan']}")
        old = store.table("physical_records", scan.drop("blobs").schema)
        gone = old.join(scan.select("physical_record_id"), "physical_record_id", "left_anti").withColumn("status", F.lit("MISSING"))
        staged["physical_records"] = store.stage("physical_records", scan.drop("blobs").unionByName(gone))
        copies_now = spark.read.parquet(f"{store.root}/physical_records/{staged['physical_records']}")
        changed = r.state_changes(copies_now, old)
        history = store.table("physical_record_history", "physical_record_id string, content string, status string, active_from string, active_to string")
        staged["physical_record_history"] = store.stage("physical_record_history", r.extend_history(history, changed, now))
        blobs = scan.select("physical_record_id", F.explode("blobs").alias("b")).select("physical_record_id", "b.*")
        archive = store.table("physical_blob_archive", blobs.schema)
        staged["physical_blob_archive"] = store.stage("physical_blob_archive", r.archived_blobs(blobs, changed, archive))
        selection = r.select_canonical(copies_now, present.select(F.col("source_key").alias("source_db_id"), "source_key"), chosen)
        picked = selection.join(copies_now.select(F.col("physical_record_id").alias("selected_id"), "content", "local_date"), "selected_id", "left")
        staged["canonical_selection"] = store.stage("canonical_selection", picked)
        picked = spark.read.parquet(f"{store.root}/canonical_selection/{staged['canonical_selection']}")
        staged["record_roles"] = store.stage("record_roles", r.roles(copies_now, picked))
        log = store.table("change_log", "logical_record_id string, change string, old_date string, new_date string, at string")
        if store.has("canonical_selection"):
            log = log.unionByName(r.change_log(store.table("canonical_selection"), picked).withColumn("at", F.lit(now)))
        staged["change_log"] = store.stage("change_log", log)
        # what the selected copies say becomes the records of the store, with the import time of those that stayed the same
        won = picked.filter("selected_id is not null").select(F.col("selected_id").alias("physical_record_id")).join(copies_now, "physical_record_id")
        records = won.select(F.col("logical_record_id").alias("source_record_id"), "source_table", "sid", "key", F.col("source_timestamp").alias("time"), "time_zero", "zone_offset", F.lit(0).alias("deleted"), F.col("value_json").alias("value"), "record_json", "content")
        before_records = store.table("canonical_records", ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in records.schema.fields) + ", imported_at string")
        staged["canonical_records"] = store.stage("canonical_records", r.mirror(records, before_records, "source_record_id", ["content"], "imported_at", F.lit(now)))
        identities = store.table("source_database_identities", present.schema)
        staged["source_database_identities"] = store.stage("source_database_identities", upsert(identities, present, ["source_key"]))
        generation = generation_id(quick, policy_version, run_id)
        generations = store.table("source_generations", "generation_id string, scanned_at string, manifest string, source_database_count int, conflict_policy_version string")
        row = spark.createDataFrame([(generation, now, json.dumps(sorted(after.values())), len(before), policy_version)], generations.schema)
        staged["source_generations"] = store.stage("source_generations", generations.unionByName(row))
        _release(store, staged)
        store.update_state(reconciled={"quick": quick, "policy": policy_version, "deep_at": now, "generation": generation})
        kinds = {x["conflict"]: x["n"] for x in store.table("canonical_selection").groupBy("conflict").agg(F.count("*").alias("n")).collect()}
        return {"status": "SUCCESS", "generation": generation, "copies": copies_now.count(), "conflicts": kinds}

    return _logged(store, "reconcile", now, run)


def generation_id(fingerprint: str, policy_version: str, last_run: str) -> str:
    """A change of the sources, of the policy or of the run that read them is another generation."""
    return hashlib.sha256("\0".join((last_run, policy_version, fingerprint)).encode()).hexdigest()


def signals(store: Store, generation: str) -> TableSource:
    """The normalized tables of a store as a source of signals, with the quality of each measurement."""
    valid = lambda c, low, high: F.when(F.col(c).between(low, high), "VALID").otherwise("INVALID")
    at = lambda name: store.table(name).withColumn("ts", F.col("timestamp_utc"))
    kinds = {
        "heart_rate": lambda: at("heart_rate").withColumn("quality", valid("bpm", 25, 240)),
        "spo2": lambda: at("spo2").withColumn("quality", n.saturation_quality(F.col("value"))),
        "stress": lambda: at("stress"),
        "sleep_session": lambda: store.table("sleep_sessions").withColumnsRenamed({"sleep_start_utc": "s", "sleep_end_utc": "t"}),
        "sleep_stage": lambda: store.table("sleep_stages").withColumnsRenamed({"start_timestamp_utc": "start", "end_timestamp_utc": "end"}).withColumns({"stage": n.stage_name(F.col("raw_state")), "flags": n.stage_flags(F.col("raw_state"))}),
        "workout": lambda: store.table("workouts").withColumnRenamed("start_timestamp_utc", "s"),
        "daily_activity": lambda: store.table("daily_summary").withColumns({"day": day_number(F.col("local_date")), "distance": F.lit(None).cast("double")}),
        "resting_heart_rate": lambda: store.table("daily_summary").filter("resting_hr > 0").select("sid", day_number(F.col("local_date")).alias("day"), "resting_hr"),
        "respiratory_rate": lambda: store.table("sleep_sessions").filter("avg_respiratory_rate > 0").select("sid", "source_record_id", F.col("sleep_end_utc").alias("t"), F.col("avg_respiratory_rate").alias("rate"), F.lit("PARTIAL").alias("quality")),
    }
    return TableSource(kinds, store.spark.createDataFrame(CAPABILITIES, "kind string, supported boolean, origin string, resolution_s int"), generation)


def _features(store: Store, days: DataFrame | None, revision: str, options: dict) -> tuple[DataFrame, DataFrame]:
    """Features of the given (sid, day), or of all days, from the normalized tables; readings of the days beside them are read too."""
    near = None if days is None else days.select("sid", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1)).alias("day")).distinct()
    dated = lambda name: store.table(name).withColumns({"ts": F.col("timestamp_utc"), "day": day_number(F.col("local_date"))})
    part = lambda x, of=near: x if of is None else x.join(of, ["sid", "day"], "left_semi")
    hr, spo2, stress = (part(dated(name)) for name in ("heart_rate", "spo2", "stress"))
    s = store.table("sleep_sessions").withColumnsRenamed({"sleep_start_utc": "s", "sleep_end_utc": "t", "avg_respiratory_rate": "respiratory"}).withColumn("off", F.coalesce("utc_offset_seconds", F.lit(0)))
    s = part(s.withColumn("day", day_number(sleep_date(F.col("t"), F.col("off")))), days).drop("day")
    g = store.table("sleep_stages").select("source_record_id", "stage_index", n.stage_name(F.col("raw_state")).alias("stage"), F.col("start_timestamp_utc").alias("start"), F.col("end_timestamp_utc").alias("end"))
    x = part(store.table("daily_summary").withColumn("day", day_number(F.col("local_date"))), days)
    given = x.select("sid", "day", F.col("steps").cast("bigint").alias("steps"), F.col("total_calories").alias("calories"), F.col("activity_duration_minutes").alias("active"), F.col("standing_count").cast("int").alias("stands"), F.when(F.col("resting_hr") > 0, F.col("resting_hr")).alias("rhr"))
    nights = f.nightly(s, g, hr, given.select("sid", "day", "rhr"), spo2, profile_revision=revision, **options)
    return nights, f.daily(given, hr, stress, spo2, profile_revision=revision)


def analyze(spark: SparkSession, store: Store, profile: DataFrame, *, now: str, profile_revision: str = "", force: bool = False, **feature_options) -> dict:
    """Features of the days that changed since the last run, and the metrics that depend on them; both as revisions.

    Metrics depend on ``HORIZON_DAYS`` days before at most; change points on all nights before, through their token: they
    are folded on from each subject's first changed day to its last night. An incremental run leaves what a full one
    would. ``profile`` has sid, field, value, effective_from, effective_to.
    """

    def run(run_id: str) -> dict:
        state = store.state()
        versions = json.dumps({"features": f.FEATURE_VERSION} | t.VERSIONS, sort_keys=True)
        full = force or not store.has("features_nightly") or not unchanged(state.get("analyzed", {}), profile=profile_revision, versions=versions)
        days = None if full else store.table("dirty_days", DIRTY)
        if days is not None and not days.take(1):
            return {"status": "NO NEW ANALYTICS INPUT"}
        made = dict(zip(("features_nightly", "features_daily"), _features(store, days, profile_revision, feature_options), strict=True))
        staged, changed = {}, []
        for name, new in made.items():
            version = store.stage(f"new_{name}", new)
            new = spark.read.parquet(f"{store.root}/new_{name}/{version}")
            staged[f"new_{name}"] = version
            old = store.table(name, new.schema)
            kept = old.limit(0) if days is None else old.join(days, ["sid", "day"], "left_anti")
            scope = old if days is None else old.join(days, ["sid", "day"], "left_semi")
            a, b = (x.select("sid", "day", "fingerprint") for x in (scope, new))
            changed.append(a.exceptAll(b).unionByName(b.exceptAll(a)).select("sid", "day"))  # also those that are gone
            staged[name] = store.stage(name, kept.unionByName(new))
        staged["changed_features"] = store.stage("changed_features", reduce(DataFrame.unionByName, changed).distinct())
        touched = spark.read.parquet(f"{store.root}/changed_features/{staged['changed_features']}")
        nights, dailies = (spark.read.parquet(f"{store.root}/{name}/{staged[name]}") for name in made)
        old = store.table("metrics", t.SCHEMA)
        if full:
            produced, kept = t.metric_table(nights, dailies, profile), old.limit(0)
        else:
            first = touched.groupBy("sid").agg(F.min("day").alias("first"))
            recent = lambda x: x.join(first, "sid").filter(F.col("day") >= F.col("first") - HORIZON_DAYS).drop("first")
            scope = touched.select("sid", F.explode(F.sequence(F.col("day"), F.col("day") + HORIZON_DAYS)).alias("day")).distinct()
            points = old.filter("metric = 'anomaly.rhr_cusum'").join(first, "sid")
            token = points.filter("day < first").groupBy("sid").agg(F.max_by("metadata", "day").alias("m")).select("sid", t.token(F.col("m")).alias("x")).select("sid", "x.*")
            others, change = t.metric_table(recent(nights), recent(dailies), profile, cusum_start=token, cusum_since=first, apart=True)
            produced = others.join(scope, ["sid", "day"], "left_semi").unionByName(change)
            out = old.filter("metric <> 'anomaly.rhr_cusum'").join(scope, ["sid", "day"], "left_anti")
            kept = out.unionByName(points.filter("day < first").drop("first")).unionByName(old.filter("metric = 'anomaly.rhr_cusum'").join(first, "sid", "left_anti"))
        staged["produced_metrics"] = store.stage("produced_metrics", produced)
        produced = spark.read.parquet(f"{store.root}/produced_metrics/{staged['produced_metrics']}")
        staged["metrics"] = store.stage("metrics", kept.unionByName(produced))
        identity = ["sid", "day", "metric", "value", "status", "version", "inputs_hash", "metadata", "profile_revision"]
        drafts = produced.withColumn("profile_revision", F.lit(profile_revision))
        revisions = store.table("metric_revisions", ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in drafts.schema.fields) + ", run_id string")
        marked = lambda x: x.withColumn("__h", F.sha2(F.to_json(F.struct(*identity), {"ignoreNullFields": "false"}), 256))
        fresh = marked(drafts).join(marked(revisions).select("__h"), "__h", "left_anti").drop("__h")
        staged["metric_revisions"] = store.stage("metric_revisions", revisions.unionByName(fresh.withColumn("run_id", F.lit(run_id))))
        staged["dirty_days"] = store.stage("dirty_days", spark.createDataFrame([], DIRTY))
        _release(store, staged)
        store.update_state(analyzed={"profile": profile_revision, "versions": versions}, last_analysis=run_id)
        return {"status": "SUCCESS", "full": full, "changed_features": store.table("changed_features").count(), "metrics": store.table("produced_metrics").count()}

    return _logged(store, "analyze", now, run)
