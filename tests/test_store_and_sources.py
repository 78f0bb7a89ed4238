"""Sources, normalization, reconciliation, store and streams on fixtures."""

import json
import sqlite3

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalframe.operators import reconcile as r
from signalframe.plans import normalize as n
from signalframe.plans import store as s
from signalframe.sources import databases as d
from signalframe.sources import profile as p
from signalframe.sources.adapter import TableSource
from signalframe.streaming import ingest

RAW = "sid string, source_record_id string, source_table string, key string, time bigint, time_zero bigint, zone_offset bigint, value string"


@pytest.fixture
def export(tmp_path):
    for region, bpm in (("cn", 60), ("ru", 61)):
        at = tmp_path / "DataBase" / "7" / region / "7.db"
        at.parent.mkdir(parents=True)
        c = sqlite3.connect(at)
        for t in ("heart_rate", "sleep", "steps"):
            c.execute(f"create table {t} (sid text, key text, time integer, value text, deleted integer, primary key (sid, key, time))")
        c.executemany("insert into heart_rate values (?, ?, ?, ?, 0)", [("d", "heart_rate", t, json.dumps({"time": t, "bpm": bpm})) for t in (100, 200)] + [("d", "x", None, "{}")])
        c.execute("create table notes (a text)")
        c.commit()
        c.close()
    (tmp_path / "DataBase" / "7" / "cn" / "7.conflict-1.db").write_bytes(b"")
    return tmp_path


def test_discovery_and_fingerprints(spark, export):
    found = d.discover(spark, export)
    assert found.count() == 3 and rows(d.discover(spark, export, skip_conflicts=True), "relative_path") == [("DataBase/7/cn/7.db",), ("DataBase/7/ru/7.db",)]
    once, again = (rows(d.fingerprints(found), "path", "quick", "manifest") for _ in "ab")
    assert once == again and len({q for _, q, _ in once}) == 3
    (export / "DataBase/7/ru/7.db-wal").write_bytes(b"x")
    after = rows(d.fingerprints(found), "path", "quick", "manifest")
    assert [a == b for a, b in zip(once, after, strict=True)] == [True, True, False]
    for nothing in (export / "nothing", export / "DataBase"):
        with pytest.raises(FileNotFoundError):
            d.discover(spark, nothing)


def test_snapshots(spark, export, tmp_path):
    dbs = d.discover(spark, export)
    got = {x["relative_path"]: x for x in d.snapshots(dbs, tmp_path / "copies").collect()}
    assert sqlite3.connect(got["DataBase/7/cn/7.db"]["snapshot"]).execute("select count(*) from heart_rate").fetchone() == (3,)
    waits, left = [], [d.SourceBusy("a"), OSError("b"), None]

    def action():
        e = left.pop(0)
        if e:
            raise e

    d.tried(action, wait=waits.append)
    assert waits == [1.0, 2.0]
    with pytest.raises(d.SourceBusy):
        d.tried(lambda: (_ for _ in ()).throw(sqlite3.DatabaseError("always")), wait=waits.append)
    assert waits == [1.0, 2.0, 1.0, 2.0, 3.0]


def test_a_copy_of_what_changes_is_refused(export, tmp_path, monkeypatch):
    ticks = iter(range(100))
    monkeypatch.setattr(d, "_group_hash", lambda *_: str(next(ticks)))
    with pytest.raises(d.SourceBusy):
        d._copied(str(export / "DataBase/7/cn/7.db"), tmp_path / "copy.sqlite")
    assert list(tmp_path.glob("*.sqlite*")) == [] and not (tmp_path / "copy.sqlite").exists()


def test_catalog_and_scan(spark, export):
    dbs = d.discover(spark, export, skip_conflicts=True)
    c = d.catalog(d.columns_of(dbs))
    assert rows(c.groupBy("table_name").agg(F.bool_and("relevant"), F.bool_and("health_store"))) == [("heart_rate", True, True), ("notes", False, True), ("sleep", True, True), ("steps", True, True)]
    odd = spark.createDataFrame([("p", t, c, 0) for t, c in (("pai", "a"), ("x", "last_rmssd_ms"), ("x", "b"), ("plain", "b"), ("MyStepLog", "b"))], "path string, table_name string, column_name string, position int")
    assert rows(d.catalog(odd).select("table_name", "relevant", "health_store").distinct()) == [("MyStepLog", True, False), ("pai", True, False), ("plain", False, False), ("x", True, False)]
    schema = StructType().add("sid", "string").add("time", "long").add("value", "string").add("absent", "double")
    assert d.scan(dbs, "heart_rate", schema).count() == 6
    assert rows(d.scan(dbs, "heart_rate", schema, cutoff=150), "time", "absent") == [(200, None), (200, None)]
    assert d.scan(dbs, "nothing", schema).count() == 0


def test_raw_records(spark, export):
    dbs = d.discover(spark, export, skip_conflicts=True).withColumn("cutoff", F.lit(None).cast("bigint"))
    c = d.catalog(d.columns_of(dbs))
    x = d.records(dbs, c)
    assert x.count() == 6 and x.select("source_record_id").distinct().count() == 3 and x.select("content").distinct().count() == 5  # regions share records, not contents
    assert rows(d.records(dbs.withColumn("cutoff", F.lit(150)), c), "time") == [(200,), (200,)]
    row = {"sid": "d", "time": 5, "value": '{ "b": 1,"a": [2]}', "extra": None, "blob": b"xyz"}
    one = d.raw_record("heart_rate", row, [])
    assert json.loads(one[2]) == {"sid": "d", "time": 5} and one[9] == '{"a":[2],"b":1}' and set(json.loads(one[10])) == {"extra", "blob"} and one[12][0]["data"] == b"xyz"
    assert one[1] == d.raw_record("heart_rate", row | {"extra": 1}, [])[1] and one[11] != d.raw_record("heart_rate", row | {"extra": 1}, [])[11]
    assert one[11] == d.raw_record("heart_rate", row | {"value": '{"a":[2],"b":1}'}, [])[11] != d.raw_record("heart_rate", row | {"blob": b"xyzz"}, [])[11]
    assert json.loads(d.raw_record("t", {"a": 1, "b": b"x"}, [])[2]) == {"a": 1} and json.loads(d.raw_record("t", {"a": 1, "c": 2}, ["c"])[2]) == {"c": 2}


def test_profiles(spark, tmp_path):
    entry = {"field": "sleep_target_min", "value": 450, "effective_from": "2025-01-01", "effective_to": "2025-02-01"}
    zones = ["Europe/Berlin", "UTC"]

    def read(*entries, **more):
        at = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        at.write_text(json.dumps({"schema_version": 1, "sid": "s", "values": list(entries)} | more))
        return p.read_profiles(spark, str(at))

    good = read(entry, entry | {"effective_from": "2025-02-02", "effective_to": None}, {"field": "timezone", "value": "UTC", "effective_from": "2025-01-01"}, {"field": "sex", "value": "x", "effective_from": "2025-01-01"})
    assert rows(p.numbers(p.checked(good, zones)), "sid", "value", "effective_from", "effective_to") == [("s", 450.0, 20089, 20120), ("s", 450.0, 20121, None)]
    assert read().count() == 0 and p.revision(read()) != p.revision(good) == p.revision(good.repartition(3))
    for bad in ({"value": 0}, {"value": -1}, {"field": "shoe"}, {"effective_to": "2024-01-01"}, {"effective_to": "soon"}, {"value": True}, {"value": "450"}, {"value": None}, {"field": "timezone", "value": "No/Where"}, {"field": "date_of_birth", "value": "1.1.1970"}, {"effective_from": None}):
        assert p.problems(read(entry | bad), zones).count() == 1, bad
        with pytest.raises(p.BadProfile):
            p.checked(read(entry | bad), zones)
    assert rows(p.problems(read(entry, entry | {"effective_from": "2025-02-01"}), zones), "problem") == [("overlaps another",)]
    assert rows(p.problems(read(entry | {"effective_to": None}, entry | {"effective_from": "2025-01-02", "effective_to": "2025-01-03"}, entry | {"effective_from": "2025-03-01", "effective_to": None}), zones), "problem") == [("overlaps another",)] * 2
    assert p.problems(read(entry, schema_version=2), zones).count() > 0


def test_text_table(spark):
    row = "| #1a Name of it | p | a | r | v | c | OK | m | n |"
    lines = lambda *x: spark.createDataFrame([(y,) for y in x], "value string")
    assert rows(p.text_table(lines("x", "| a | b |", row, row.replace("1a", "2")), {"OK"}), "id", "metric", "status", "notes") == [("1a", "Name of it", "OK", "n"), ("2", "Name of it", "OK", "n")]
    for bad in ([row, row], [row.replace("OK", "NO")], ["| #x | 2 |"], [row.replace("#1a", "#a1")]):
        with pytest.raises(Exception):  # noqa: B017
            p.text_table(lines(*bad), {"OK"}).collect()


def test_canonical_text(spark):
    from signalframe.functions import identity as i

    df = spark.sql("select named_struct('b', array(1, null), 'a', map('y', 1.5D, 'x', null)) as s, cast('ab' as binary) as blob, 'say \"hi\"' as t, date '2025-01-02' as d, cast(null as int) as n, true as flag")
    got = df.select(*[i.canonical_text(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).first()
    assert (got["s"], got["t"], got["d"], got["n"], got["flag"]) == ('{"a":{"x":null,"y":1.5000000000000000},"b":[1,null]}', '"say \\"hi\\""', '"2025-01-02"', "null", "true") and got["blob"].startswith('{"length":2,')
    for odd in ("nan", "inf"):
        with pytest.raises(Exception):  # noqa: B017
            spark.createDataFrame([(float(odd),)], "x double").select(i.canonical_text(F.col("x"), df.schema["s"].dataType["a"].dataType.valueType)).collect()


def test_record_in_three_and_its_hash(spark):
    from signalframe.functions import identity as i

    schema = "sid string, time bigint, value string, extra int, blob binary"
    rows_ = [("d", 5, '{"b": 1, "a": 2}', 7, bytearray(b"x")), ("d", 5, '{"a":2,"b":1}', 7, bytearray(b"x")), ("d", 5, "{broken", 7, None), ("d", 5, '{"a":2,"b":1}', 8, bytearray(b"x"))]
    df = spark.createDataFrame(rows_, schema)
    split = df.select(*[c.alias(k) for k, c in i.split_record(df.schema).items()]).collect()
    assert split[0]["value_json"] == split[1]["value_json"] == '{"a":2,"b":1}' and split[2]["value_json"] == "{broken" and [len(x["blobs"]) for x in split] == [1, 1, 0, 1]
    assert json.loads(split[0]["scalars"])["extra"] == 7 and set(json.loads(split[0]["scalars"])) == {"extra", "blob"}
    h = [x[0] for x in df.select(i.content_hash(df.schema)).collect()]
    assert h[0] == h[1] and len(set(h)) == 3
    assert i.key_columns(df.schema) == ["sid", "time"] and i.key_columns(df.schema, ["extra"]) == ["extra"] and i.key_columns(df.select("extra", "blob").schema) == ["extra"]


def test_adapter(spark):
    t = TableSource({"heart_rate": lambda: spark.createDataFrame([(1, 60.0), (5, 61.0)], "ts bigint, bpm double")}, spark.createDataFrame([("heart_rate",)], "kind string"), "g1")
    assert rows(t.read("heart_rate", 1, 5), "ts") == [(1,)] and t.generation() == "g1" and t.capabilities().count() == 1
    with pytest.raises(KeyError):
        t.read("dreams")
    with pytest.raises(TypeError):
        t.read("heart_rate", 1.5)


# normalization


def raw(spark, *records):
    return spark.createDataFrame([("d", f"r{i}", t, k, at, None, off, json.dumps(v) if not isinstance(v, str) else v) for i, (t, k, at, off, v) in enumerate(records)], RAW)


def test_samples(spark):
    x = raw(spark, ("heart_rate", "heart_rate", 100, 3600, {"time": 90, "bpm": 60}), ("heart_rate", "single_heart_rate", 100, None, {"time": 0, "bpm": "61.5"}), ("heart_rate", "heart_rate", 1, 0, {"bpm": True}), ("heart_rate", "resting_heart_rate", 1, 0, {"bpm": 50}), ("heart_rate", "heart_rate", 1, 0, "{broken"), ("spo2", "spo2", 5, 0, {"spo2": 97}), ("steps", "steps", 5, 0, {"steps": 10.9, "calories": "x"}), ("intensity", "i", 5, 0, {}))
    assert rows(n.samples(x, "heart_rate"), "timestamp_utc", "local_timestamp", "bpm", "kind") == [(90, 3690, 60.0, "heart_rate"), (100, 100, 61.5, "single_heart_rate")]
    assert rows(n.samples(x, "spo2"), "value") == [(97.0,)] and rows(n.samples(x, "steps"), "steps", "calories") == [(10, None)] and n.samples(x, "intensity").count() == 1


def test_events(spark):
    x = raw(spark, ("heart_rate", "high_heart_rate", 100, 0, {"start_time": 1, "end_time": 0, "items": [{"time": 1, "value": 150}, 7, {"time": 2, "value": 160}]}))
    assert rows(n.heart_rate_events(x), "end_timestamp_utc", "sample_count", "min_bpm", "max_bpm") == [(100, 3, 150.0, 160.0)]
    assert rows(n.heart_rate_event_samples(x), "sample_index", "value") == [(0, 150.0), (2, 160.0)]


def test_sleep_and_workouts(spark):
    x = raw(
        spark, ("sleep", "night", 900, 0, {"bedtime": 0, "device_bedtime": 5, "duration": 100, "items": [{"state": 2, "start_time": 10, "end_time": 130}, {"state": 9, "start_time": 130, "end_time": 100}, {"state": 3, "start_time": 1}]}),
        ("sleep", "nap", 900, 0, {"bedtime": 7, "wake_up_time": 800, "duration": 100}), ("sport", "run", 50, 0, {"end_time": 90, "total_cal": 12, "sport_type": 3}), ("valid_stand", "", 50, 0, {"start_time": 1, "end_time": 2}),
    )
    assert rows(n.sleep_sessions(x), "sleep_start_utc", "sleep_end_utc", "has_stages", "is_nap_inferred") == [(5, 900, 1, 0), (7, 800, 0, 1)]
    assert rows(n.sleep_stages(x), "stage_index", "stage", "duration_minutes") == [(0, "deep", 2.0), (1, "unknown_9", -0.5)]
    assert rows(n.workouts(x, "sport"), "start_timestamp_utc", "calories", "sport_type") == [(50, 12.0, "3")]
    assert n.standing_intervals(x).count() == 1


def test_daily_precedence(spark):
    x = raw(spark, ("sleep_day", "", 50, 0, {"avg_hr": 55, "segment_details": [{"avg_breath": 14}, {"avg_breath": 16}]}), ("heart_rate_day", "", 60, 0, {"avg_hr": 70, "avg_rhr": 0, "min_hr": 40}), ("heart_rate", "resting_heart_rate", 70, 0, {"bpm": 52}), ("steps_day", "", 70, 0, {"steps": 0}))
    day = n.daily_summary(x).first()
    assert (day["avg_hr"], day["min_hr"], day["resting_hr"], day["steps"], day["avg_respiratory_rate"], day["max_hr"]) == (55.0, 40.0, 52.0, 0.0, 15.0, None)


def test_flatten(spark):
    x = raw(spark, ("vitality", "", 1, 0, {"a": 1, "b": {"c": True, "d": {"e": {"f": 5, "g": {"h": 1}}}}, "s": "t", "n": None, "l": [1], "time": 3}))
    got = rows(n.flatten(n.with_payload(x), ["source_record_id"], F.col("payload")), "field_path", "numeric_value", "text_value")
    assert got == [("a", 1.0, None), ("b.c", 1.0, None), ("b.d.e.f", 5.0, None), ("n", None, None), ("s", None, "t")]


def test_saturation_and_stage_quality(spark):
    v = spark.createDataFrame([(None,), (0.0,), (-1.0,), (97.0,), (100.5,)], "v double")
    assert [x[0] for x in v.select(n.saturation_quality(F.col("v"))).collect()] == ["MISSING", "SENTINEL,INVALID", "SENTINEL,INVALID", "VALID", "INVALID"]
    g = spark.createDataFrame([(2,), (9,), (None,)], "c int")
    assert [tuple(x) for x in g.select(n.stage_name(F.col("c")), n.stage_flags(F.col("c"))).collect()] == [("deep", "VENDOR_DERIVED"), ("unknown", "UNKNOWN_SEMANTICS,VENDOR_DERIVED"), ("unknown", "UNKNOWN_SEMANTICS,VENDOR_DERIVED")]
    x = raw(spark, ("vitality", "", 1, 0, {"a": 1}), ("heart_rate", "heart_rate", 1, 0, {"bpm": 60}))
    assert rows(n.derived_metrics(x), "sid", "source_table", "field_path") == [("d", "vitality", "a")]


# reconciliation

COPIES = "physical_record_id string, logical_record_id string, source_db_id bigint, source_timestamp bigint, local_date string, value_json string, status string, content string"


def test_selection_and_roles(spark):
    c = spark.createDataFrame([("p1", "a", 1, 1, "d", "v", "ACTIVE", "x"), ("p2", "a", 2, 1, "d", "v", "ACTIVE", "y"), ("p3", "b", 1, 1, "d", "v", "ACTIVE", "x"), ("p4", "b", 2, 1, "d", "w", "ACTIVE", "y"), ("p5", "c", 1, 1, "d", "v", "TOMBSTONE", "x"), ("p6", "d", 1, 1, "d", "v", "ACTIVE", "x"), ("p7", "d", 2, 1, "d", "v", "ACTIVE", "x"), ("p8", "d", 3, 1, "d", "v", "MISSING", "x")], COPIES)
    src = spark.createDataFrame([(1, "account:7:region:cn"), (2, "account:7:region:ru")], "source_db_id bigint, source_key string")
    pick = lambda name: {x["logical_record_id"]: (x["selected_id"], x["conflict"]) for x in r.select_canonical(c, src, r.POLICIES[name]).collect()}
    assert pick("ru_compat") == {"a": ("p2", "EQUIVALENT_PHYSIOLOGY_METADATA_DIFF"), "b": ("p4", "UNRESOLVED_SELECTED_FOR_COMPATIBILITY"), "c": (None, "NONE"), "d": ("p7", "DUPLICATE_EQUAL")}
    assert pick("cn_review")["b"][0] == "p3" and pick("unresolved_exclude")["b"] == (None, "UNRESOLVED_EXCLUDED")
    got = dict(rows(r.roles(c, r.select_canonical(c, src, r.POLICIES["ru_compat"])), "physical_record_id", "role"))
    assert got == {"p1": "DUPLICATE_EQUIVALENT", "p2": "PRIMARY", "p3": "CONFLICT_ALTERNATIVE", "p4": "PRIMARY", "p5": "TOMBSTONE_SOURCE", "p6": "DUPLICATE_EQUAL", "p7": "PRIMARY", "p8": "SOURCE_MISSING"}


def test_versions_and_missing(spark):
    seen = spark.createDataFrame([("p", 1, i, c, st) for i, (c, st) in enumerate([("x", "ACTIVE"), ("x", "ACTIVE"), ("y", "ACTIVE"), ("y", "MISSING"), ("y", "ACTIVE")])] + [("q", 1, 3, "z", "ACTIVE")], "physical_record_id string, source_db_id int, scanned int, content string, status string")
    assert [(x["content"], x["status"], x["active_from"], x["active_to"]) for x in r.versions(seen).filter("physical_record_id = 'p'").orderBy("active_from").collect()] == [("x", "ACTIVE", 0, 2), ("y", "ACTIVE", 2, 3), ("y", "MISSING", 3, 4), ("y", "ACTIVE", 4, None)]
    assert rows(r.missing(seen), "physical_record_id") == [("q",)]
    state = lambda *data: spark.createDataFrame(data, "physical_record_id string, content string, status string")
    none = spark.createDataFrame([], "physical_record_id string, content string, status string, active_from string, active_to string")
    a, b = state(("p", "x", "ACTIVE"), ("q", "y", "ACTIVE")), state(("p", "x", "ACTIVE"), ("q", "y", "MISSING"), ("r", "z", "ACTIVE"))
    h = r.extend_history(r.extend_history(none, r.state_changes(a, a.limit(0)), "t1"), r.state_changes(b, a), "t2")
    assert rows(h) == [("p", "x", "ACTIVE", "t1", None), ("q", "y", "ACTIVE", "t1", "t2"), ("q", "y", "MISSING", "t2", None), ("r", "z", "ACTIVE", "t2", None)]


def test_change_log_and_mirror(spark):
    schema = "logical_record_id string, selected_id string, content string, local_date string, conflict string"
    a = spark.createDataFrame([("1", "p", "x", "d", "NONE"), ("2", "p", "x", "d", "NONE"), ("3", "p", "x", "d", "NONE"), ("4", None, None, None, "NONE"), ("5", "p", "x", "d", "NONE")], schema)
    b = spark.createDataFrame([("1", "p", "y", "d", "NONE"), ("2", None, None, None, "X"), ("3", "q", "x", "d", "X"), ("4", "p", "x", "d", "NONE"), ("5", "p", "x", "d", "NONE")], schema)
    assert rows(r.change_log(a, b), "logical_record_id", "change") == [("1", "UPDATE"), ("2", "DELETE"), ("3", "CONFLICT_CHANGE"), ("4", "INSERT")]
    old = spark.createDataFrame([("k", 1, "then"), ("l", 1, "then")], "k string, c int, at string")
    new = spark.createDataFrame([("k", 1), ("l", 2), ("m", 1)], "k string, c int")
    assert rows(r.mirror(new, old, "k", ["c"], "at", F.lit("now")), "k", "at") == [("k", "then"), ("l", "now"), ("m", "now")]


# store


def test_publish_state_and_log(spark, tmp_path):
    st = s.Store(spark, str(tmp_path))
    assert st.table("t", "a int").count() == 0
    st.publish("t", spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Exception):  # noqa: B017
        st.publish("t", spark.createDataFrame([(1,)], "a int").select(F.raise_error(F.lit("stop")).alias("a")))
    assert rows(st.table("t")) == [(1,)]
    st.update_state(digest="x")
    assert s.unchanged(st.state(), digest="x") and not s.unchanged(st.state(), digest="y") and not s.unchanged(st.state())
    at = lambda h: f"2025-01-0{1 + h // 24}T{h % 24:02}:00:00+00:00"
    assert s.unchanged(st.state(), deep_at=at(0), now=at(23), digest="x") and not s.unchanged(st.state(), deep_at=at(0), now=at(24), digest="x") and not s.unchanged(st.state(), now=at(0), digest="x")
    st.log_run("r1", "RUNNING", "t0")
    st.log_run("r1", "FAILED", "t0", "t1", "why")
    assert rows(st.runs(), "run_id", "status") == [("r1", "FAILED")]
    for k in range(3):
        st.publish("t", spark.createDataFrame([(k,)], "a int"))
    assert rows(st.table("t")) == [(2,)] and len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("v-")]) == 2  # one version is kept for reads that go on
    with st.lock("x"), pytest.raises(RuntimeError), st.lock("x"):
        pass
    with st.lock("x"):
        pass
    (tmp_path / "state.json").write_text('{"schema_version": 99}')
    (tmp_path / ".state.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        s.Store(spark, str(tmp_path))


def test_merges(spark):
    f = lambda data: spark.createDataFrame(data, "k int, a int, b int")
    old, new = f([(1, 1, 1), (2, 2, 2)]), f([(2, None, 9), (3, 3, None)])
    assert rows(s.upsert(old, new, ["k"])) == [(1, 1, 1), (2, None, 9), (3, 3, None)]
    assert rows(s.partial_upsert(old, new, ["k"])) == [(1, 1, 1), (2, 2, 9), (3, 3, None)]
    assert rows(s.replace_children(old, f([]), f([(2, 0, 0)]), "k")) == [(1, 1, 1)]
    assert rows(s.classify(new, old, ["k"], "b"), "k", "change") == [(2, "updated"), (3, "new")]
    assert rows(s.evolve(old, {"b": ("int", F.lit(7)), "c": ("string", F.lit("x"))}), "b", "c") == [(1, "x"), (2, "x")]
    drafts = spark.createDataFrame([(1, 1, None), (1, 2, None)], "k int, v int, w int")
    one = s.add_revisions(spark.createDataFrame([], "k int, v int, w int, revision int"), drafts.filter("v = 1"), ["k", "v", "w"])
    two = s.add_revisions(one, drafts, ["k", "v", "w"])
    assert two.count() == 2 and s.add_revisions(two, drafts, ["k", "v", "w"]).count() == 2 and rows(s.active(two, ["k"]), "v") == [(2,)]
    ptr = spark.createDataFrame([(1, "m1"), (1, "m2"), (2, "m2")], "day int, metric string")
    made = spark.createDataFrame([(1, "m1")], "day int, metric string")
    assert rows(s.retract(ptr, made, spark.createDataFrame([(1,)], "day int"), ["day", "metric"], ["day"]), "day", "metric") == [(1, "m1"), (2, "m2")]
    assert s.cutoff(10 * 86400 + 5) == 8 * 86400


def test_incremental_equals_full(spark):
    from signalframe.operators import metrics as m

    before = [60 + (i * 7) % 11 for i in range(60)]
    after = [*before]
    after[40] = 90
    series = lambda v: spark.createDataFrame([("s", i, float(x)) for i, x in enumerate(v)], "sid string, day bigint, v double")
    full = lambda v: m.bands(series(v), "sid", "v", m.BANDS["rhr"]).select("sid", "day", "state", F.round("mean", 9).alias("mean"))
    days = s.affected_days(spark.createDataFrame([("s", 40)], "sid string, day bigint"), "sid")
    assert rows(s.refresh(full(after), full(before), days, "sid")) == rows(full(after))


# streams


def test_stream_equals_batch(spark, tmp_path):
    x = raw(spark, *[("heart_rate", "heart_rate", 100 + 86400 * (i % 3), 0, {"bpm": 60 + i}) for i in range(20)])
    for part in range(2):
        x.filter(F.expr(f"crc32(source_record_id) % 2 = {part}")).write.mode("append").parquet(str(tmp_path / "in"))
    x.limit(5).write.mode("append").parquet(str(tmp_path / "in"))  # delivered again
    st = s.Store(spark, str(tmp_path / "store"))
    stream = ingest.read_raw(spark, str(tmp_path / "in"), RAW, files_per_batch=1)
    ingest.normalize_into(stream, st, "hr", lambda b: n.samples(b, "heart_rate"), ["source_record_id"], str(tmp_path / "cp"), part="local_date").awaitTermination()
    assert rows(st.parts("hr", "a int"), "source_record_id", "bpm") == rows(n.samples(x, "heart_rate"), "source_record_id", "bpm")


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    st = s.Store(spark, str(tmp_path))
    f = lambda *data: spark.createDataFrame(data, "k int, v int, day string")
    st.merge_parts("t", f((1, 1, "2025-01-01"), (2, 2, "2025-01-02"), (3, 3, None)), ["k"], "day")
    before = st._json("t/parts.json")["parts"]
    st.merge_parts("t", f((2, 9, "2025-01-02"), (4, 4, "2025-01-02")), ["k"], "day")
    after = st._json("t/parts.json")["parts"]
    assert rows(st.parts("t", "k int"), "k", "v") == [(1, 1), (2, 9), (3, 3), (4, 4)] and {p for p in before if before[p] != after[p]} == {"2025-01-02"}
    st.merge_parts("t", f((2, 9, "2025-01-02")), ["k"], "day")
    assert st.parts("t", "k int").count() == 4 and st.parts("none", "k int").count() == 0


def test_windowed_rates(spark, tmp_path):
    spark.createDataFrame([("a", 10, 60.0), ("a", 10, 60.0), ("a", 20, 80.0), ("a", 700, 50.0)], "sid string, ts bigint, bpm double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("sid string, ts bigint, bpm double").parquet(str(tmp_path / "in"))
    q = ingest.windowed_rates(stream).writeStream.format("memory").queryName("rates").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("rates"), "n", "mean") == [(1, 50.0), (2, 70.0)]


# status, profiles, guards


def test_status(spark):
    from signalframe.plans import status

    m = spark.createDataFrame([("s", "anomaly.rhr", "2025-01-02", 100, 1.0, "VALID"), ("s", "anomaly.rhr", "2025-01-01", 50, 0.0, "VALID"), ("s", "x", "2025-01-02", 100, float("nan"), "VALID"), ("s", "y", "2025-01-01", 10, 5.0, "ODD")], "sid string, metric string, date string, last_end bigint, value double, status string")
    h = rows(status.headlines(m, ["anomaly.rhr", "y"], F.lit("2025-01-02"), F.lit(200)), "metric", "freshness", "value")
    assert h == [("anomaly.rhr", "FRESH", 1.0), ("y", "HISTORICAL", None)]
    assert rows(status.insane(m, {"anomaly.rhr": (0, 0.5)})) == [("anomaly.rhr", 1), ("x", 1), ("y", 1)]
    assert status.anomalies(m).count() == 1 and status.counts(m).count() == 3
    assert json.loads(status.report(counts=status.counts(m)))["counts"]


def test_report_has_every_row_in_order(spark):
    from signalframe.plans import status

    df = spark.range(2500).select(F.format_string("s%04d", 2499 - F.col("id")).alias("sid"), F.lit(None).cast("double").alias("value"))
    want = [{"sid": f"s{i:04d}", "value": None} for i in range(2500)]
    assert json.loads(status.report(headlines=df, few=df.limit(1)))["headlines"] == want
    assert status.report(headlines=df.repartition(7)) == status.report(headlines=df)
    assert [json.loads(x) for n, x in rows(status.report_rows(headlines=df, few=df.limit(1))) if n == "headlines"] == want


def test_json_keys(spark):
    from signalframe.operators.json_profile import json_keys

    df = spark.createDataFrame([('{"a": 1, "b": {"c": [1, 2.5, "x"]}, "s": "{\\"in\\": true}"}',), ('{"a": null}',), ("{broken",), (None,), ("7",)], "t string")
    assert rows(json_keys(df, "t"), "path", "kind", "n") == [("a", "null", 1), ("a", "number", 1), ("b", "object", 1), ("b.c", "array", 1), ("s", "string", 1), ("s{json}.in", "boolean", 1)]
    deep = spark.createDataFrame([('{"l": [{"x": 3}, {"x": 1.5}, "[{\\"y\\": 2}]", 7]}',), ("[" * 500 + "]" * 500,)], "t string")
    assert rows(json_keys(deep, "t", "x|y"), "path", "n", "lowest", "highest") == [("l[].x", 2, 1.5, 3.0), ("l[]{json}[].y", 1, 2.0, 2.0)]


def test_headlines_of_a_subject(spark):
    from signalframe.plans import status

    day = 20000
    m = spark.createDataFrame([("a", day, "sleep.score", 80.0, "VALID", "{}"), ("a", day, "sleep.need_min", 450.0, "VALID", "{}"), ("a", day, "sleep.debt_min", None, "CALIBRATING", "{}"), ("a", day, "anomaly.rhr", 1.0, "VALID", "{}"), ("a", day, "anomaly.spo2", 0.0, "VALID", "{}"), ("a", day - 3, "anomaly.spo2", 1.0, "VALID", "{}"), ("a", day, "recovery.score", 70.0, "REDUCED", '{"z_sleep": 0.1}'), ("b", day - 9, "sleep.score", 60.0, "VALID", "{}"), ("b", day - 9, "anomaly.rhr", 1.0, "VALID", "{}")], "sid string, day bigint, metric string, value double, status string, metadata string")
    nights = spark.createDataFrame([("a", day, day * 86400 + 20000, 60.0, 97.0, None), ("b", day - 9, (day - 9) * 86400 + 20000, 61.0, None, None)], "sid string, day bigint, t bigint, rhr double, spo2_mean double, respiratory double")
    got = {r["sid"]: r for r in status.overview(m, nights, F.lit(day), F.lit(day * 86400 + 40000)).collect()}
    a, b = got["a"], got["b"]
    assert (a["freshness"], a["score"], a["need_min"], a["debt_min"], a["recovery"], a["recovery_status"], a["active_anomalies"], a["latest_anomaly_day"], a["signals_available"]) == ("FRESH", 80.0, 450.0, None, 70.0, "REDUCED", ["anomaly.rhr"], day, ["rhr", "spo2"])
    assert (b["freshness"], b["score"], b["active_anomalies"], b["latest_anomaly_day"], b["signals_available"]) == ("HISTORICAL", None, None, day - 9, ["rhr"])
    assert a["sleep_statuses"]["sleep.debt_min"] == "CALIBRATING" and b["sleep_statuses"] == {"sleep.score": "VALID"}


def test_guards(spark):
    src = lambda data: spark.createDataFrame(data, "source_key string, relative_path string")
    r.check_sources(src([("a", "x")]), src([("a", "y"), ("b", "z")]))
    for present in ([("b", "z")], [("a", "x"), ("a", "y")]):
        with pytest.raises(r.Refused):
            r.check_sources(src([("a", "x")]), src(present))
    blobs = spark.createDataFrame([("p", "c", "h1"), ("q", "c", "h2")], "physical_record_id string, column_name string, sha256 string")
    once = r.archived_blobs(blobs, blobs.filter("physical_record_id = 'p'"), blobs.limit(0))
    assert once.count() == 1 and r.archived_blobs(blobs, blobs, once).count() == 2
