"""Operators of the general problems on small cases and against plain versions."""

import random
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from signalframe.functions.instants import with_instant
from signalframe.operators import snapshots
from signalframe.operators.intervals import latest_version, periods_and_gaps
from signalframe.operators.outliers import Rules, excursions, implausible_readings
from signalframe.operators.regular import daily_values, empty_slots, regular_series, trailing, with_calendar
from signalframe.operators.snapshots import content_words, snapshot_changes
from signalframe.plans.problems import QUERIES

# mixed timestamps
T = 1750241445  # 2025-06-18T10:10:45Z
SPELLINGS = [
    (str(T), 0), (f"{T}.5", 500), (f"{T}123", 123), (f"{T}123456", 123), ("2025-06-18 12:10:45", 0), ("2025-06-18T12:10:45.250", 250), ("2025-06-18T10:10:45Z", 0), ("20250618T101045Z", 0), ("2025-06-18T15:40:45+05:30", 0),
    ("2025-06-18 05:10:45-0500", 0), ("18.06.2025 12:10:45", 0), ("18/06/2025 12:10:45", 0), ("06/18/2025 12:10:45 PM", 0), ("Wed, 18 Jun 2025 12:10:45 +0200", 0), ("2025-06-18T12:10:45+02:00[Europe/Berlin]", 0), (" 2025-06-18T10:10:45Z ", 0),
]
NONE = [None, "", "  ", "--", "n/a", "pending", "0000-00-00 00:00:00", "2025-02-30 10:00:00", "2025-06-18 24:10:00", "2025-06-18 10:60:00", "13/13/2025 10:00:00", "x" * 10_000, "2025-06-18T10:10:45+25:00", "06/18/2025 13:10:45 PM"]


def instants(spark, data):
    df = spark.createDataFrame(data, "text string, off int, zone string, day string")
    return [r[0] for r in with_instant(df, "text", "off", "zone", "day").select("instant_us").collect()]


def test_spellings_of_one_instant(spark):
    assert instants(spark, [(s, 7200, None, None) for s, _ in SPELLINGS]) == [T * 1_000_000 + ms * 1000 + (456 if s.endswith("123456") else 0) for s, ms in SPELLINGS]


def test_texts_without_instant(spark):
    assert instants(spark, [(s, 7200, None, None) for s in NONE]) == [None] * len(NONE)


def test_local_time_needs_an_offset_or_a_known_zone(spark):
    local = "2025-06-18 12:10:45"
    assert instants(spark, [(local, None, "Europe/Berlin", None), (local, None, "No/Where", None), (local, None, None, None), (local, 7200, "Asia/Tokyo", None)]) == [T * 1_000_000, None, None, T * 1_000_000]


def test_order_of_day_and_month(spark):
    at = lambda m, d: int(datetime(2025, m, d, 8, tzinfo=timezone.utc).timestamp()) * 1_000_000
    got = instants(spark, [("05/06/2025 08:00:00", 0, None, "2025-05-06"), ("05/06/2025 08:00:00", 0, None, "2025-06-05"), ("05/06/2025 08:00:00", 0, None, None), ("05/06/2025 08:00:00 AM", 0, None, None), ("05/13/2025 08:00:00", 0, None, None), ("05/06/2025 08:00:00", 0, None, "nonsense")])
    assert got == [at(5, 6), at(6, 5), at(6, 5), at(5, 6), at(5, 13), at(6, 5)]


def test_instants_agree_with_the_zone_database(spark):
    rnd = random.Random(1)
    zones = ["Europe/Berlin", "America/New_York", "Asia/Kathmandu", "Australia/Adelaide", "America/Sao_Paulo"]
    data, want = [], []
    for _ in range(200):
        d = datetime.fromtimestamp(rnd.randrange(1_600_000_000, 1_800_000_000), timezone.utc).replace(tzinfo=None)
        z = rnd.choice(zones)
        data.append((d.strftime("%Y-%m-%d %H:%M:%S"), None, z, None))
        want.append(int(d.replace(tzinfo=ZoneInfo(z)).timestamp()) * 1_000_000)
    assert instants(spark, data) == want


# snapshots
GENERATIONS = [("b", datetime(2025, 1, 1)), ("a", datetime(2025, 1, 2)), ("c", datetime(2025, 1, 3)), ("empty", datetime(2025, 1, 4))]
REC = "physical_record_id string, source_db_id bigint, last_seen_generation string, last_seen_at string, status string, content_hash string, extra string"


def changes(spark, data):
    g = spark.createDataFrame(GENERATIONS, "generation_id string, scanned_at timestamp")
    return rows(snapshot_changes(spark.createDataFrame(data, REC), g))


def test_snapshot_changes(spark):
    h1, h2 = "00" * 16, "AB" * 16
    data = [
        ("k1", 1, "b", "2025-01-01T00:00:00Z", "ACTIVE", h1, None), ("k1", 1, "a", "2025-01-02T00:00:00Z", "ACTIVE", f"X'{h1}'", None),
        ("k2", 1, "b", "2025-01-01T00:00:00Z", "ACTIVE", h2, None), ("k2", 1, "a", "2025-01-02T00:00:00Z", "ACTIVE", h1, None), ("k2", 1, "a", "2025-01-02T09:00:00+10:00", "ACTIVE", h2.lower(), None),
        ("k3", 1, "b", "2025-01-01T00:00:00Z", "ACTIVE", h1, None), ("k3", 1, "a", "2025-01-02T00:00:00Z", "MISSING", h1, None),
        ("k4", 1, "a", "2025-01-02T00:00:00Z", "ACTIVE", h1, None), ("k5", 2, "b", "2025-01-01T00:00:00Z", "ACTIVE", h1, None), ("k5", 2, "c", "2025-01-03T00:00:00Z", "ACTIVE", h2, None),
        ("k6", 2, "c", "2025-01-03T00:00:00Z", "ACTIVE", None, None), (None, 2, "c", "2025-01-03T00:00:00Z", "ACTIVE", h1, None), ("k7", 2, "unknown", "x", "ACTIVE", h1, None),
    ]
    assert changes(spark, data) == [("a", "k2", "changed"), ("a", "k3", "removed"), ("a", "k4", "added"), ("c", "k5", "changed"), ("c", "k6", "added")]
    assert changes(spark, data * 3) == changes(spark, data)
    assert changes(spark, data[:0]) == []


def test_snapshot_changes_against_sets(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "ROWS_AT_ONCE", 20)
    rnd = random.Random(3)
    data, state = [], {}
    for g, day in (("b", 1), ("a", 2), ("c", 3)):
        for k in range(60):
            if rnd.random() < 0.8:
                s, h = rnd.choice(["ACTIVE", "ACTIVE", "TOMBSTONE"]), rnd.choice(["11", "22"]) * 16
                data.append((f"k{k}", k % 3, g, f"2025-01-0{day}T00:00:00Z", s, h, None))
                state[g, f"k{k}"] = (s, h)
    want = []
    for old, new in (("b", "a"), ("a", "c")):
        for k in (f"k{i}" for i in range(60)):
            a, b = (h if s == "ACTIVE" else None for s, h in (state.get((g, k), ("", "")) for g in (old, new)))
            if a != b:
                want.append((new, k, "added" if a is None else "removed" if b is None else "changed"))
    assert changes(spark, data) == sorted(want)


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_buckets_are_compared_whole(monkeypatch, limit):
    """However many rows are held at once, and however they arrive, the differences are those of all rows together."""
    import pyarrow as pa

    rng = np.random.default_rng(limit)
    n = 400
    k1 = rng.integers(0, 60, n)
    c = {"bucket": (k1 % 9).astype(np.int32), "src": k1 % 3, "k1": k1, "k2": k1 * 7, "snap": rng.integers(1, 4, n).astype(np.int32), "more": np.ones(n, bool), "seen": rng.integers(0, 5, n), "present": rng.random(n) < 0.7, "h1": rng.integers(0, 2, n), "h2": np.zeros(n, np.int64)}
    order = np.argsort(c["bucket"], kind="stable")
    c = {k: v[order] for k, v in c.items()}
    key = lambda d: sorted(zip(*(np.asarray(d[x]).tolist() for x in ("src", "k1", "snap", "change")), strict=True))
    want = key(snapshots.diff_bucket(c))
    whole = pa.RecordBatch.from_arrays([pa.array(v) for v in c.values()], names=list(c))
    monkeypatch.setattr(snapshots, "ROWS_AT_ONCE", limit)
    for size in (1, 13, 400):
        out = list(snapshots._diff(whole.slice(i, size) for i in range(0, n, size)))
        assert sorted(sum((key({x: b.column(x) for x in b.schema.names}) for b in out), [])) == want


def test_spellings_of_content(spark):
    hexed = "0123456789abcdef0123456789abcdef"
    df = spark.createDataFrame([(x,) for x in (hexed, hexed.upper(), f"0x{hexed}", f"X'{hexed}'", "01234567-89ab-cdef-0123-456789abcdef", "ASNFZ4mrze8BI0VniavN7w==")], "h string")
    assert len(set(rows(df.select(*content_words(F.col("h")))))) == 1


# intervals
def periods(spark, data, **k):
    df = spark.createDataFrame(data, "sid string, s bigint, t bigint, nap int")
    return rows(periods_and_gaps(df, "sid", "s", "t", F.col("nap") == 1, **k))


def test_periods(spark):
    data = [("a", 0, 10, 0), ("a", 10, 20, 1), ("a", 12, 15, 0), ("a", 30, 40, 1), ("a", 30, 35, 1), ("a", None, 5, 0), ("a", 9, 9, 0), ("a", 50, 45, 0), ("b", 5, 6, None), (None, 0, 9, 0)]
    assert periods(spark, data) == [("a", "gap", 20, 30), ("a", "main", 0, 20), ("a", "nap", 30, 40), ("b", "main", 5, 6)]
    assert periods(spark, []) == []


@pytest.mark.parametrize("shard", [7, 50, 10_000])
def test_periods_against_a_sweep(spark, shard):
    rnd = random.Random(shard)
    data = [(e, s, s + rnd.choice([1, 3, 9, 60]), rnd.randint(0, 1)) for e in "abc" for s in (rnd.randrange(0, 900) for _ in range(60))]
    want = []
    for e in "abc":
        cur = None
        for s, t, nap in sorted((s, t, nap) for x, s, t, nap in data if x == e):
            if cur and s <= cur[1]:
                cur = (cur[0], max(cur[1], t), cur[2] and nap)
            else:
                if cur:
                    want += [(e, "nap" if cur[2] else "main", cur[0], cur[1]), (e, "gap", cur[1], s)]
                cur = (s, t, nap)
        want.append((e, "nap" if cur[2] else "main", cur[0], cur[1]))
    assert periods(spark, data, shard_seconds=shard) == sorted(want)


def test_latest_version(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, None), ("y", None, 7), ("y", 1, 3)], "k string, v int, a int")
    assert rows(latest_version(df, "k", "v", "a")) == [("x", None), ("y", 3)]


# grid
def test_empty_slots(spark):
    df = spark.createDataFrame([("a", 5), ("a", 601), ("a", 2500), ("a", 2501), ("a", 90_000), ("b", 7), (None, 3), ("c", None)], "sid string, at bigint")
    got = rows(empty_slots(df, "sid", F.col("at"), step=600, shard=3600))
    assert got == [("a", k * 600) for k in range(151) if k not in (0, 1, 4, 150)]
    assert rows(empty_slots(df, "sid", F.col("at"), step=600, shard=86400)) == got


def test_regular_series_has_every_slot(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("a", 10, 3.0), ("a", 4000, 7.0), ("a", 4001, None)], "sid string, at bigint, v double")
    got = rows(regular_series(df, "sid", F.col("at"), "v", step=600, shard=1200))
    assert [(r[1] // 600, r[2], r[4], r[5]) for r in got] == [(0, 2, False, 2.0)] + [(k, 0, True, 2.0) for k in range(1, 6)] + [(6, 1, False, 7.0)]


@pytest.mark.parametrize("shard", [1200, 3600, 86400])
def test_series_do_not_depend_on_shards(spark, shard):
    rnd = random.Random(4)
    data = [(e, rnd.randrange(0, 200_000), float(rnd.randrange(9))) for e in "ab" for _ in range(25)] + [("a", -86_400 * 30, 1.0)]
    df = spark.createDataFrame(data, "sid string, at bigint, v double")
    got = {}
    for sid, at, n, mean, empty, carried in rows(regular_series(df, "sid", F.col("at"), "v", step=600, shard=shard)):
        assert (sid, at) not in got and empty == (n == 0) == (mean is None)
        got[sid, at] = (n, carried)
    for e in "ab":
        of = {}
        for x, at, v in data:
            if x == e:
                of.setdefault(at // 600, []).append(v)
        last = None
        for k in range(min(of), max(of) + 1):
            last = sum(of[k]) / len(of[k]) if k in of else last
            n, carried = got.pop((e, k * 600))
            assert n == len(of.get(k, ())) and abs(carried - last) < 1e-9
    assert not got


# rolling totals
def test_daily_values_and_calendar(spark):
    data = [("a", "2025-01-01", 1, 5), ("a", "2025-01-01", 2, None), ("a", "2025-01-01", 3, 7), ("a", "2025-01-04", 1, None), ("a", "bad", 1, 9), ("a", "2025-01-06", 1, 1)]
    df = spark.createDataFrame(data, "sid string, d string, at int, v int")
    days = with_calendar(daily_values(df, "sid", "d", "at", {"v": F.col("v")}), ["v"])
    first = 20089
    assert rows(days) == [("a", first, 7), *[("a", first + k, None) for k in range(1, 5)], ("a", first + 5, 1)]
    total = rows(days.select("day", F.coalesce(F.sum("v").over(trailing(3)), F.lit(0))))
    assert [t for _, t in total] == [7, 7, 7, 0, 0, 1]


# outliers
def flags(spark, series, **k):
    data = [(f"s{n}", f"s{n}-{i}", float(v) if v is not None else None, t * 1_000_000 if t is not None else None) for n, s in enumerate(series) for i, (t, v) in enumerate(s)]
    df = spark.createDataFrame(data, "sid string, id string, v double, t bigint")
    return {(r[0], r[1]) for r in implausible_readings(df, "sid", "id", "v", "t", **k).collect()}


def steady(n, level=70, start=0, step=300, seed=0):
    rnd = random.Random(seed)
    return [(start + i * step, level + rnd.choice([-1, 0, 1, 2]) + (i % 2) * 0.5) for i in range(n)]


def test_excursions_and_what_is_none():
    def run(x):
        return excursions(np.zeros(len(x), np.int64), np.arange(len(x), dtype=np.int64) * 300_000_000, np.asarray(x, float), Rules()).nonzero()[0].tolist()

    base = [70, 71, 70, 72, 71, 70, 71, 72, 70, 71]
    assert run([*base, 34, *base]) == [10]
    assert run([*base, 140, 138, 141, *base]) == [10, 11, 12]
    assert run([*base, *([140] * 4), *base]) == []  # four readings are no short excursion
    assert run([*base, *range(75, 140, 9), *range(135, 75, -9), *base]) == []  # builds up and fades
    assert run([*base, *[x + 40 for x in base]]) == []  # a lasting shift
    assert run([*base, 140]) == []  # no return
    assert run([70]) == [] and run([]) == []


@pytest.mark.parametrize("shard", [3600 * 5, 86400 * 8])
def test_flags_do_not_depend_on_shards(spark, shard):
    a = steady(200)
    a[20] = (a[20][0], 300.0)
    a[50] = (a[50][0], 33.0)
    for i in range(100, 118):
        a[i] = (a[i][0], 70.0)
    b = steady(60, seed=2) + [(None, 5.0), (None, 80.0), (1, None)]
    want = {("s0-20", "impossible"), ("s0-50", "excursion"), ("s1-60", "impossible")} | {(f"s0-{i}", "frozen") for i in range(100, 118)}
    got = flags(spark, [a, b], shard_seconds=shard, halo_seconds=3600 * 2)
    assert want <= got and {x for x in got - want if x[1] != "frozen"} == set()


@pytest.mark.parametrize("shard", [3600 * 5, 86400 * 8])
def test_excursions_next_to_long_silences(spark, shard):
    day = 86400
    before, after, inside, both = steady(40), steady(40), steady(40), steady(60)
    before[19] = (before[19][0], 140.0)
    after[20] = (after[20][0], 140.0)
    inside[19], inside[20] = (inside[19][0], 140.0), (inside[20][0], 141.0)
    both[20] = (both[20][0] + 3 * day, 140.0)
    both[21:] = [(t + 6 * day, v) for t, v in both[21:]]
    silence = lambda s: [*s[:20], *((t + 3 * day, v) for t, v in s[20:])]
    daily = steady(60, step=day)
    daily[30] = (daily[30][0], 140.0)
    shift = [*steady(20), *steady(20, level=110, start=3 * day)]
    got = flags(spark, [silence(before), silence(after), silence(inside), both, daily, shift], shard_seconds=shard)
    assert {x for x in got if x[1] == "excursion"} == {(i, "excursion") for i in ("s0-19", "s1-20", "s2-19", "s2-20", "s3-20", "s4-30")}


@pytest.mark.parametrize("shard", [3600, 3600 * 5, 86400])
def test_excursions_in_shards_are_those_of_the_whole(spark, shard):
    rnd = random.Random(shard)
    t, s = 0, []
    for _ in range(1500):
        t += rnd.choice([300] * 30 + [7000, 90_000, 400_000])
        s.append((t, float(rnd.choice([68, 69, 70, 71, 72, 73] * 6 + [33, 110, 130, 250]))))
    v = np.array([x for _, x in s])
    p = np.flatnonzero((v >= 25) & (v <= 240))
    whole = p[excursions(np.zeros(len(p), np.int64), np.array([t for t, _ in s])[p] * 1_000_000, v[p], Rules())]
    assert len(whole) > 50
    assert {x for x in flags(spark, [s], shard_seconds=shard) if x[1] == "excursion"} == {(f"s0-{i}", "excursion") for i in whole}


def frozen(spark, *runs):
    """Lengths of the frozen runs of each source whose runs have these lengths."""
    found = flags(spark, [[(300 * i, v) for i, v in enumerate(v for k, n in enumerate(r) for v in [70 + k % 2] * n)] for r in runs])
    ends = [np.cumsum(r) for r in runs]
    return [[n for n, e in zip(r, ends[s], strict=True) if {(f"s{s}-{i}", "frozen") for i in range(e - n, e)} <= found] for s, r in enumerate(runs)]


def test_frozen_runs_of_sources_with_few_runs(spark):
    short = [1, 2, 1, 1, 3, 1, 2] * 2
    coarse = [4, 9, 6, 12, 7, 10, 5, 11, 8]
    got = frozen(spark, [*short, 40, *short], [*short, 30, *short, 12, *short], [1, 1, 40], [40], [12] * 9, coarse, [*coarse, 40, *coarse], [*short, 6, *short])
    assert got == [[40], [30, 12], [40], [40], [], [], [40], []]


def test_rules_are_parameters(spark):
    a = steady(60)
    a[20], a[30:34] = (a[20][0], 80.0), [(t, 90.0) for t, _ in a[30:34]]
    small = Rules(least_jump=5.0, highest=85.0)
    assert flags(spark, [a]) == set()
    assert flags(spark, [a], rules=small) == {("s0-20", "excursion")} | {(f"s0-{i}", "impossible") for i in range(30, 34)}
    assert {x for x in flags(spark, [a], rules=Rules(least_run=4)) if x[1] == "frozen"} == {(f"s0-{i}", "frozen") for i in range(30, 34)}


def test_readings_without_instant_are_judged_by_bounds(spark):
    data = [(None, v) for v in (10.0, 70.0, 300.0)] * 200
    assert len(flags(spark, [data])) == 400


def test_outliers_of_nothing(spark):
    df = spark.createDataFrame([], "sid string, id string, v double, t bigint")
    assert implausible_readings(df, "sid", "id", "v", "t").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_give_rows_once(spark, name):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df = QUERIES[name](spark, f"{DATA}/sf0.001").cache()
    assert df.count() == df.distinct().count() > 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
