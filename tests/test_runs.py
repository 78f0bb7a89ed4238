"""Runs from exports to metrics: what is read, what is skipped, and that an incremental run leaves what a full one would."""

import json
import math
import sqlite3

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalframe.operators import reconcile as r
from signalframe.plans import runs
from signalframe.plans.store import Store
from signalframe.sources import databases as db

NOW = "2025-09-01T00:00:00+00:00"
DAY = 86400
FIRST = 20000
TABLES = ("heart_rate", "sleep", "steps", "spo2", "stress", "heart_rate_day", "steps_day")


def at(root, region="cn"):
    return root / "DataBase" / "7" / region / "7.db"


def write(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    c = sqlite3.connect(path)
    for t in TABLES:
        c.execute(f"create table if not exists {t} (sid text, key text, time integer, value text, zone_offset integer, deleted integer default 0, sensor blob, primary key (sid, key, time))")
    for table, sid, key, time, value, *more in records:
        c.execute(f"insert or replace into {table} (sid, key, time, value, zone_offset, deleted, sensor) values (?, ?, ?, ?, 0, ?, ?)", (sid, key, time, json.dumps(value), *(more or (0, None))))
    c.commit()
    c.close()


def night(day, rate, sid="a"):
    """Eight hours that end at four on the day, with stages, heart rates, and the rate of the day."""
    t = (FIRST + day) * DAY + 14400
    s = t - 28800
    edges = [(2, 0, 10800), (3, 10800, 19800), (5, 19800, 21600), (4, 21600, 28800)]
    items = [{"state": k, "start_time": s + a, "end_time": s + b} for k, a, b in edges]
    out = [("sleep", sid, "night", t, {"bedtime": s, "wake_up_time": t, "duration": 480, "avg_breath": 16 + day % 2, "has_stage": True, "items": items}), ("heart_rate_day", sid, "day", t, {"avg_rhr": rate}), ("steps_day", sid, "day", t, {"steps": 1000 + day})]
    return out + [("heart_rate", sid, "heart_rate", s + 1800 * i, {"bpm": rate + i % 3}) for i in range(16)] + [("spo2", sid, "spo2", s + 1800 * i, {"spo2": 96}) for i in range(16)]


def rates(n):
    return [round(55 + 3 * math.sin(i), 1) for i in range(n)]


def history(n, sid="a"):
    return [x for i, v in enumerate(rates(n)) for x in night(i, v, sid)]


@pytest.fixture(autouse=True)
def interpreted(spark):
    """Runs have many small plans: compiling them takes far longer than these rows do."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def profile(spark):
    return spark.createDataFrame([("a", "sleep_target_min", 450.0, FIRST, None)], "sid string, field string, value double, effective_from bigint, effective_to bigint")


def test_ingest_reads_what_is_new(spark, tmp_path):
    root, work, store = tmp_path / "src", tmp_path / "work", Store(spark, str(tmp_path / "store"))
    write(at(root), *history(3))
    go = lambda **k: runs.ingest(spark, store, str(root), str(work), now=NOW, **k)
    first = go()
    assert first["status"] == "SUCCESS" and first["new"] == 3 * 35 and store.table("heart_rate").count() == 48 and store.table("sleep_stages").count() == 12 and store.table("daily_summary").count() == 3
    assert go() == {"status": "NO NEW SOURCE DATA"}
    write(at(root), ("heart_rate", "a", "heart_rate", (FIRST - 1) * DAY, {"bpm": 300}), ("heart_rate", "a", "resting_heart_rate", (FIRST + 2) * DAY, {"bpm": 50}), ("sleep", "a", "night", (FIRST + 2) * DAY + 14400, {"bedtime": (FIRST + 2) * DAY - 3600, "wake_up_time": (FIRST + 2) * DAY + 14400, "duration": 300}))
    later = go()
    assert (later["new"], later["updated"]) == (1, 1)  # what is older than the overlap isn't read
    assert store.table("sleep_stages").count() == 8  # a session that lost its stages
    assert store.state()["warnings"] == 0
    assert go(force=True)["new"] == 1 and rows(store.table("heart_rate").filter("bpm = 300"), "sid") == [("a",)]
    assert rows(runs.warnings(store), "warning") == [("heart_rate_range",)] and [x["status"] for x in store.runs().collect()].count("SUCCESS") == 3


def test_a_failed_run_leaves_the_store(spark, tmp_path, monkeypatch):
    root, work, store = tmp_path / "src", tmp_path / "work", Store(spark, str(tmp_path / "store"))
    write(at(root), *history(2))
    runs.ingest(spark, store, str(root), str(work), now=NOW)
    before, state = rows(store.table("heart_rate")), store.state()
    write(at(root), *night(2, 60))

    def stop(*_):
        raise ValueError("stop")

    monkeypatch.setitem(runs.RULES, "workouts", stop)
    with pytest.raises(ValueError):
        runs.ingest(spark, store, str(root), str(work), now=NOW)
    assert rows(store.table("heart_rate")) == before and store.state() == state
    assert sorted(x["status"] for x in store.runs().collect()) == ["FAILED", "SUCCESS"]
    monkeypatch.undo()
    monkeypatch.setattr(db, "_copied", lambda *_: (_ for _ in ()).throw(db.SourceBusy("busy")))
    monkeypatch.setattr(runs.db, "snapshots", lambda x, _: x.withColumns({"snapshot": F.lit(None).cast("string"), "busy": F.lit("busy")}))
    assert runs.ingest(spark, store, str(root), str(work), now=NOW)["status"] == "SKIPPED"


SHOWN = ("sid", "day", "metric", "value", "status", "n_inputs", "inputs_hash")


def shown(store):
    return rows(store.table("metrics").withColumn("value", F.round("value", 9)), *SHOWN)


def test_incremental_equals_full(spark, tmp_path, profile):
    """A night that changes more than 90 days before the end, another that vanishes from its day, and a new one."""
    root, work = tmp_path / "src", tmp_path / "work"
    write(at(root), *history(100), *history(8, "b"))
    store = Store(spark, str(tmp_path / "store"))
    analyze = lambda s, **k: runs.analyze(spark, s, profile, now=NOW, rate_minutes=120, rate_least=3, **k)
    runs.ingest(spark, store, str(root), str(work), now=NOW)
    full = analyze(store)
    assert full["status"] == "SUCCESS" and full["full"] and analyze(store) == {"status": "NO NEW ANALYTICS INPUT"}
    before = shown(store)
    gone = (FIRST + 40) * DAY + 14400
    write(at(root), *night(4, 75.0), *night(100, 58.0), ("sleep", "a", "night", gone, {}, 1, None), ("heart_rate_day", "a", "day", gone, {"avg_rhr": 0}))
    runs.ingest(spark, store, str(root), str(work), now=NOW, force=True)
    part = analyze(store)
    assert not part["full"] and part["changed_features"] < 16
    after = shown(store)
    assert after != before and max(d for _, d, *_ in set(after) ^ set(before)) > FIRST + 95
    assert {x for x in after if x[0] == "b"} == {x for x in before if x[0] == "b"}
    from signalframe.plans import status

    x = status.status(store, F.lit(FIRST + 100), F.lit((FIRST + 100) * DAY + 2 * 14400))
    one = {r["sid"]: r["freshness"] for r in x["overview"].collect()}
    assert one == {"a": "FRESH", "b": "HISTORICAL"} and x["sanity"].count() == 0 and x["validate"].first()["sleep_sessions"] == 108 and len(json.loads(status.report(**x))) == 7
    revisions = store.table("metric_revisions").count()
    assert revisions >= len(before) and analyze(store, force=True)["full"] and shown(store) == after and store.table("metric_revisions").count() == revisions  # nothing new to keep


def test_reconcile(spark, tmp_path):
    root, work, store = tmp_path / "src", tmp_path / "work", Store(spark, str(tmp_path / "store"))
    same, other = ("heart_rate", "a", "heart_rate", 5, {"bpm": 60}), ("heart_rate", "a", "heart_rate", 6, {"bpm": 60})
    for region, bpm in (("cn", 61), ("ru", 62)):
        write(at(root, region), same, other, ("heart_rate", "a", "heart_rate", 7, {"bpm": bpm}), ("heart_rate", "a", "heart_rate", 8, {"bpm": 1}, int(region == "cn"), b"xyz"))
    go = lambda now=NOW, **k: runs.reconcile(spark, store, str(root), str(work), now=now, **k)
    first = go()
    assert first["copies"] == 8 and first["conflicts"] == {"DUPLICATE_EQUAL": 2, "UNRESOLVED_SELECTED_FOR_COMPATIBILITY": 1, "NONE": 1} and store.table("change_log").count() == 0
    assert rows(store.table("canonical_records"), "time", "value") == [(5, '{"bpm":60}'), (6, '{"bpm":60}'), (7, '{"bpm":62}'), (8, '{"bpm":1}')]
    assert dict(rows(store.table("record_roles").groupBy("role").count()))["TOMBSTONE_SOURCE"] == 1 and store.table("physical_blob_archive").count() == 2
    assert go("2025-09-01T23:00:00+00:00") == {"status": "NO NEW SOURCE DATA"} and go("2025-09-02T00:00:00+00:00")["status"] == "SUCCESS"  # a day after the deep scan
    assert go("2025-09-02T01:00:00+00:00", policy="cn_review")["generation"] != first["generation"]
    assert rows(store.table("change_log"), "change") == [("UPDATE",)] and rows(store.table("source_generations"), "conflict_policy_version")[-1] == (f"{runs.CONFLICT_POLICY_VERSION}:ru_compat",)
    c = sqlite3.connect(at(root, "cn"))
    c.execute("delete from heart_rate where time in (6, 7)")
    c.commit()
    c.close()
    go("2025-09-02T02:00:00+00:00", policy="cn_review")
    assert dict(rows(store.table("physical_records").groupBy("status").count())) == {"ACTIVE": 5, "MISSING": 2, "TOMBSTONE": 1}
    assert rows(store.table("canonical_records").filter("time = 7"), "value") == [('{"bpm":62}',)] and store.table("canonical_records").filter(F.col("imported_at") == NOW).count() == 3
    assert store.table("physical_record_history").filter("active_to is not null").count() == 2 and store.table("physical_record_history").count() == 10
    at(root, "ru").unlink()
    with pytest.raises(r.Refused):
        go("2025-09-02T03:00:00+00:00")
    assert dict(rows(store.runs().groupBy("status").count()))["FAILED"] == 1 and store.table("physical_records").count() == 8


def test_a_source_that_changes_meanwhile_is_not_published(spark, tmp_path, monkeypatch):
    root, work, store = tmp_path / "src", tmp_path / "work", Store(spark, str(tmp_path / "store"))
    write(at(root), *history(1))
    real = db.snapshots

    def later(x, folder):
        out = real(x, folder)
        made = spark.createDataFrame(out.collect(), out.schema)
        write(at(root), *night(1, 60))
        return made

    monkeypatch.setattr(runs.db, "snapshots", later)
    assert runs.reconcile(spark, store, str(root), str(work), now=NOW)["status"] == "SKIPPED" and not store.has("physical_records")
