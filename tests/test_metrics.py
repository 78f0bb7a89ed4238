"""Rules of features and metrics on fixtures with known results."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalframe.functions import clock, numeric
from signalframe.operators import metrics as m
from signalframe.operators import statistics as st
from signalframe.operators.joins import as_of, effective, interval_join
from signalframe.operators.windows import calendar, max_gap, runs, series_in, trailing_sum, with_next
from signalframe.plans import features as f

D0 = 20000


def frame(spark, values, first=D0, sid="s"):
    return spark.createDataFrame([(sid, first + i, float(v) if v is not None else None) for i, v in enumerate(values)], "sid string, day bigint, v double")


def at(df, day, *columns):
    return tuple(df.filter(F.col("day") == day).select(*columns).first() or ())


# expressions


def test_casts(spark):
    df = spark.createDataFrame([(x,) for x in ("12", " -3 ", "12.5", "true", "", None, "99999999999999999999", "1e3")], "t string")
    assert [r[0] for r in df.select(numeric.as_int(F.col("t"))).collect()] == [12, -3, None, None, None, None, None, None]
    assert [r[0] for r in df.select(numeric.as_float(F.col("t"))).collect()][:4] == [12.0, -3.0, 12.5, None]
    v = spark.createDataFrame([(float("nan"),), (5.0,), (500.0,), (None,), (float("inf"),)], "v double")
    assert [r[0] for r in v.select(numeric.finite_between(F.col("v"), 0, 100)).collect()] == [None, 5.0, None, None, None]
    z = spark.createDataFrame([(0, 7), (None, 7), (3, 7)], "a int, b int")
    assert [r[0] for r in z.select(numeric.truthy_or(F.col("a"), F.col("b"))).collect()] == [7, 7, 3]


def test_clock(spark):
    df = spark.createDataFrame([(86400 * 10, 0), (86400 * 10 - 3600, 7200), (-60, 0), (86400 * 10, None)], "t bigint, off int")
    got = df.select(clock.sleep_date(F.col("t"), clock.usable_offset(F.col("off"))).cast("string"), clock.clock_minute(F.col("t"), clock.usable_offset(F.col("off")))).collect()
    assert [tuple(r) for r in got] == [("1970-01-10", 0), ("1970-01-11", 60), ("1969-12-31", 1439), ("1970-01-10", 0)]
    far = spark.createDataFrame([(10**14, None)], "t bigint, off int")
    assert far.select(clock.local_date(F.col("t"), F.col("off"))).first()[0] is None


def test_dates_in_zones(spark):
    df = spark.sql("select timestamp '2025-03-29 23:30:00' as t, z, o from values ('Europe/Berlin', 0), (null, -7200), (null, 1800) v(z, o)")
    assert [str(r[0]) for r in df.select(clock.date_at(F.col("t"), zone=F.col("z"), offset=F.col("o"))).collect()] == ["2025-03-30", "2025-03-29", "2025-03-30"]
    with pytest.raises(Exception):  # noqa: B017
        df.select(clock.date_at(F.col("t"), zone=F.col("z"))).collect()


def test_freshness(spark):
    df = spark.createDataFrame([(None, 100, True), ("2025-01-01", 100, True), ("2025-01-02", 200_000, True), ("2025-01-02", 99_000, True), ("2025-01-02", 99_000, False), ("2025-01-02", 200, True)], "d string, t bigint, cur boolean")
    fresh = clock.freshness(F.col("d"), F.lit("2025-01-02"), F.col("t"), F.lit(150_000), F.col("cur"))
    assert [r[0] for r in df.select(fresh).collect()] == ["MISSING", "HISTORICAL", "STALE", "FRESH", "STALE", "STALE"]


def test_statistics(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0, 10.0],), ([5.0],), ([],)], "a array<double>")
    a = F.col("a")
    got = [tuple(None if v is None else round(v, 6) for v in r) for r in df.select(st.array_median(a), st.array_sd(a), st.ewma(a)).collect()]
    assert got[0][:2] == (2.5, round(math.sqrt(sum((x - 4) ** 2 for x in (3, 1, 2, 10)) / 4), 6)) and got[1] == (5.0, 0.0, 5.0) and got[2] == (None, None, None)
    e = 3.0
    for x in (1.0, 2.0, 10.0):
        e += (x - e) * 2 / 31
    assert got[0][2] == round(e, 6)
    clockwise = spark.createDataFrame([([1430.0, 10.0],)], "a array<double>")
    assert round(clockwise.select(st.circular_sd(a, F.lit(0.0))).first()[0], 6) == 10.0
    assert round(clockwise.select(st.circular_mean(F.lit(-1.0), F.lit(0.0))).first()[0], 6) == -360.0


def test_theil_sen_ignores_an_outlier(spark):
    series = frame(spark, [i if i != 7 else 500 for i in range(20)])
    got = {r["window_days"]: (round(r["per_week"], 6) if r["per_week"] is not None else None, r["n"], r["max_gap"]) for r in m.trends(series, ["sid"], "v").filter(F.col("day") == D0 + 19).collect()}
    assert got == {14: (7.0, 14, 1), 30: (7.0, 20, 1), 90: (None, 20, 1)}
    assert {r["per_week"] for r in m.trends(frame(spark, [1, 2, 3]), ["sid"], "v").collect()} == {None}


@pytest.mark.parametrize("shard", [30, 91, 400])
def test_trends_do_not_depend_on_shards(spark, shard):
    rnd = random.Random(shard)
    values = [rnd.gauss(0, 1) if rnd.random() < 0.8 else None for _ in range(260)]
    got = {(r["day"], r["window_days"]): r for r in m.trends(frame(spark, values).withColumn("h", F.col("day") * 31), ["sid"], "v", shard=shard, mark="h").collect()}
    seen = [(D0 + i, v) for i, v in enumerate(values) if v is not None]
    assert len(got) == 3 * len(seen)
    for day, _ in seen:
        for width, least in m.TREND_WINDOWS:
            x = [(e, v) for e, v in seen if day - width < e <= day]
            r, gap, mark = got[day, width], max((b[0] - a[0] for a, b in zip(x, x[1:], strict=False)), default=0), 0
            for e, _ in x:
                mark ^= e * 31
            assert (r["n"], r["max_gap"], r["marks"]) == (len(x), gap, mark)
            slopes = sorted((b[1] - a[1]) / (b[0] - a[0]) for i, a in enumerate(x) for b in x[i + 1 :])
            if len(x) >= least and len(x) >= 0.6 * width and gap <= 7:
                k = len(slopes)
                assert abs(r["per_week"] - 7 * (slopes[(k - 1) // 2] + slopes[k // 2]) / 2) < 1e-9
            else:
                assert r["per_week"] is None


# joins and windows


@pytest.mark.parametrize("bucket", [7, 1000])
def test_interval_join_against_pairs(spark, bucket):
    rnd = random.Random(bucket)
    pts = [(rnd.choice("ab"), rnd.randrange(300)) for _ in range(80)]
    spans = [(rnd.choice("ab"), i, s, s + rnd.choice([0, 1, 5, 90])) for i, s in enumerate(rnd.randrange(300) for _ in range(40))] + [("a", 99, None, 5)]
    p, s = spark.createDataFrame(pts, "e string, at int"), spark.createDataFrame(spans, "e string, id int, s int, t int")
    want = sorted((i, at) for e, at in pts for x, i, a, b in spans if x == e and a is not None and a <= at < b)
    assert rows(interval_join(p, s, ["e"], "at", "s", "t", bucket=bucket), "id", "at") == want
    left = interval_join(p, s, ["e"], "at", "s", "t", how="left", bucket=bucket).groupBy("id").agg(F.count("at").alias("n"))
    assert rows(left) == sorted((i, sum(1 for j, _ in want if j == i)) for _, i, _, _ in spans)


def test_interval_join_makes_no_pairs(spark):
    p, s = spark.createDataFrame([("a", 1)], "e string, at int"), spark.createDataFrame([("a", 0, 5)], "e string, s int, t int")
    plan = interval_join(p, s, ["e"], "at", "s", "t")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("shard", [3, 20, 10_000])
def test_as_of_and_runs_do_not_depend_on_shards(spark, shard):
    rnd = random.Random(shard)
    pts = [(rnd.choice("ab"), rnd.randrange(200), i) for i in range(150)] + [("c", 5, 999)]
    states = [(rnd.choice("ab"), rnd.randrange(200), i) for i in range(25)]
    want = sorted((i, max(((s, v) for x, s, v in states if x == e and s <= at), default=(0, -1))[1]) for e, at, i in pts)
    p, s = spark.createDataFrame(pts, "e string, at int, i int"), spark.createDataFrame(states, "e string, since int, v int")
    assert [(i, -1 if v is None else v) for i, v in rows(as_of(p, s, ["e"], "at", "since", ["v"], shard=shard), "i", "v")] == want
    count = 0
    for e in "abc":
        ts = sorted(at for x, at, _ in pts if x == e)
        count += sum(1 for a, b in zip([None, *ts], ts, strict=False) if a is None or not 1 <= b - a <= 2)
    got = runs(p, ["e"], "at", 1, 2, shard=shard).groupBy("e", "run").agg(F.count("*").alias("n"), (F.max("at") - F.min("at")).alias("d"))
    assert got.count() == count and got.agg(F.sum("n")).first()[0] == len(pts)


def test_as_of(spark):
    p = spark.createDataFrame([("a", 5, "x"), ("a", 10, "y"), ("a", 0, "z"), ("b", 9, "w")], "e string, at int, name string")
    s = spark.createDataFrame([("a", 1, 1), ("a", 10, 2), ("a", 10, 3)], "e string, since int, v int")
    assert rows(as_of(p, s, ["e"], "at", "since", ["v"]), "name", "v") == [("w", None), ("x", 1), ("y", 3), ("z", None)]


def test_effective(spark):
    p = spark.createDataFrame([("a", "need", 1.0, 10, 19), ("a", "need", 2.0, 20, None), ("a", "other", 9.0, 0, None), ("b", "need", 7.0, 15, 15)], "sid string, field string, value double, effective_from int, effective_to int")
    days = spark.createDataFrame([(s, x) for s in "abc" for x in (9, 10, 15, 19, 20, 999)], "sid string, day int")
    got = effective(days, p, ["sid"], "need", "day")
    assert rows(got, "sid", "day", "need") == [*[("a", x, v) for x, v in ((9, None), (10, 1.0), (15, 1.0), (19, 1.0), (20, 2.0), (999, 2.0))], *[("b", x, 7.0 if x == 15 else None) for x in (9, 10, 15, 19, 20, 999)], *[("c", x, None) for x in (9, 10, 15, 19, 20, 999)]]


@pytest.mark.parametrize("name", ["join_effective", "met_sleep_debt", "met_recovery", "join_interval", "join_asof"])
def test_plans_have_no_nested_loops(spark, name):
    from conftest import DATA

    from signalframe.plans import catalog

    plan = catalog.queries()[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_following_and_trailing(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), rnd.randrange(300), i) for i in range(200)]
    df = spark.createDataFrame(data, "e string, at int, i int")
    ordered = {e: sorted((at, i) for x, at, i in data if x == e) for e in "ab"}
    want = sorted((i, ordered[e][k + 1][0] if k + 1 < len(ordered[e]) else -1) for e in "ab" for k, (_, i) in enumerate(ordered[e]))
    totals = {(e, at): sum(1 for t, _ in ordered[e] if at - 20 < t <= at) for e, at, _ in data}
    counted = df.groupBy("e", "at").agg(F.count("*").alias("n"))
    for shard in (25, 100, 10_000):
        assert [(i, -1 if v is None else v) for i, v in rows(with_next(df, ["e"], "at", ["at", "i"], shard=shard), "i", "following")] == want
        assert {(e, at): t for e, at, t in rows(trailing_sum(counted, ["e"], "at", "n", 20, shard=shard))} == totals
    with pytest.raises(ValueError):
        trailing_sum(counted, ["e"], "at", "n", 20, shard=10)


def test_runs_and_gaps(spark):
    df = spark.createDataFrame([("a", t) for t in (1, 2, 3, 3, 4, 9)], "e string, t int")
    assert [n for _, n in rows(runs(df, ["e"], "t", 1, 2).groupBy("run").count())] == [3, 2, 1]
    s = frame(spark, [1, None, 3, 4]).withColumn("p", series_in(calendar(["sid"], "day", -9, 0), "day", "v"))
    assert at(s.withColumn("g", max_gap(F.col("p"))), D0 + 3, "g") == (2,)


# metrics


def test_bands(spark):
    b = m.bands(frame(spark, [60] * 6 + [63, 63.5, 57, 56.9]), "sid", "v", m.BANDS["rhr"])
    assert at(b, D0 + 4, "state") == ("CALIBRATING",)
    assert at(b, D0 + 6, "state", "upper", "deviation") == ("IN_RANGE", 63.0, 3.0)
    spo2 = m.bands(frame(spark, [97] * 6), "sid", "v", m.BANDS["spo2"])
    assert at(spo2, D0 + 5, "lower", "upper") == (95.5, None)
    resp = m.bands(frame(spark, [16] * 6), "sid", "v", m.BANDS["respiratory"])
    assert round(at(resp, D0 + 5, "upper")[0], 6) == 16.8
    stale = m.bands(frame(spark, [60] * 6 + [None] * 16 + [60, None] + [None] * 40 + [60]), "sid", "v", m.BANDS["rhr"])
    assert at(stale, D0 + 22, "state") == ("STALE",) and at(stale, D0 + 23, "state") == ("NO_DATA",) and at(stale, D0 + 64, "state") == ("CALIBRATING",)  # what is before the window counts for nothing


def test_no_look_ahead(spark):
    values = [60 + (i * 7) % 11 for i in range(40)]
    for g in (lambda s: m.bands(s, "sid", "v", m.BANDS["rhr"]).select("day", "state", F.round("mean", 9)), lambda s: m.cusum(s, "sid", "v").select("day", "state"), lambda s: m.ewmas(s, "sid", "v").select("day", F.round("ewma", 9))):
        short, whole = rows(g(frame(spark, values[:30]))), rows(g(frame(spark, values)))
        assert short == [r for r in whole if r[0] < D0 + 30]


def test_regularity(spark):
    n = spark.createDataFrame([("s", D0 + i, 1430 if i % 2 else 10, 420) for i in range(6)], "sid string, day bigint, bed int, wake int")
    r = m.regularity(n, "sid", "bed", "wake")
    assert at(r, D0 + 5, "regularity", "status") == (100.0, "VALID") and at(r, D0 + 2, "status") == ("CALIBRATING",)
    whole = m.regularity(n.withColumn("whole", F.col("day") != D0 + 3), "sid", "bed", "wake", complete="whole")
    assert at(whole, D0 + 5, "n") == (5,) and at(whole, D0 + 3, "n") == ()


NIGHT = "sid string, day bigint, tst double, deep double, rem double, waso double, bedtime double, awakenings array<double>, complete boolean"


def nights(spark, last, count=6):
    base = (480.0, 90.0, 90.0, 0.0, 1380.0, [], True)
    return spark.createDataFrame([("s", D0 + i, *base) for i in range(count - 1)] + [("s", D0 + count - 1, *last)], NIGHT)


def test_sleep_score(spark):
    parts = ("duration", "stages", "consistency", "interruptions", "score")
    assert at(m.sleep_score(nights(spark, (480.0, 90.0, 90.0, 0.0, 1380.0, [], True)), "sid"), D0 + 5, *parts) == (100, 100, 100, 100, 100)
    assert at(m.sleep_score(nights(spark, (720.0, 90.0, 90.0, 0.0, 1380.0, [], True)), "sid"), D0 + 5, "duration") == (50,)
    assert at(m.sleep_score(nights(spark, (480.0, 90.0, 90.0, 80.0, 1380.0, [10.0] * 4, True)), "sid"), D0 + 5, "interruptions") == (11,)
    assert at(m.sleep_score(nights(spark, (480.0, 90.0, 90.0, 0.0, 60.0, [], True)), "sid"), D0 + 5, "consistency") == (0,)
    assert at(m.sleep_score(nights(spark, (480.0, None, 90.0, 0.0, 60.0, [], True)), "sid"), D0 + 5, "status", "score") == ("INSUFFICIENT_DATA", None)
    assert at(m.sleep_score(nights(spark, (480.0, 400.0, 90.0, 0.0, 60.0, [], True)), "sid"), D0 + 5, "status") == ("INVALID",)
    assert at(m.sleep_score(nights(spark, (480.0, 90.0, 90.0, 0.0, 1380.0, [], True), 4), "sid"), D0 + 3, "status") == ("CALIBRATING",)


def owed(spark, nights, given=lambda day: 480.0):
    df = spark.createDataFrame([("s", d, float(v)) for d, v in nights], "sid string, day bigint, v double")
    cal = m.ledger(df, "sid").join(df, ["sid", "day"], "left")
    target = F.create_map(*[F.lit(x) for d in range(D0 - 20, D0 + 40) for x in (d, given(d))])[F.col("day").cast("int")]
    return m.sleep_debt(cal.withColumns({"target": F.coalesce(target, F.lit(480.0)), "dflt": target.isNull()}), "sid", "v", "target", "dflt")


def test_sleep_debt(spark):
    n = [(D0 + i, 420) for i in range(14)]
    last = D0 + 13
    assert at(owed(spark, n), last, "debt_min", "status") == (840.0, "VALID")
    assert at(owed(spark, [x for x in n if x[0] - D0 not in (5, 6, 7)]), last, "status", "longest_missing") == ("CALIBRATING", 3)
    two = [x for x in n if x[0] - D0 not in (5, 6)]
    assert at(owed(spark, two, lambda d: None if d == D0 + 3 else 480.0), last, "status", "debt_min") == ("REDUCED", 720.0)
    # a default on a day without a night counts too, one before the window doesn't
    assert at(owed(spark, two, lambda d: None if d == D0 + 5 else 480.0), last, "status") == ("REDUCED",) and at(owed(spark, two, lambda d: None if d < D0 else 480.0), last, "status") == ("VALID",)
    assert at(owed(spark, [(d, 540) for d, _ in n]), last, "debt_min") == (0.0,)
    assert rows(owed(spark, n), "day") == [(d,) for d, _ in n]


def test_targets_must_be_possible(spark):
    df = spark.createDataFrame([(None,), (300.0,), (720.0,)], "t double")
    assert [r[0] for r in df.select(m.sleep_target(F.col("t"))).collect()] == [480.0, 300.0, 720.0]
    for bad in (299.0, 721.0, float("nan")):
        with pytest.raises(Exception):  # noqa: B017
            spark.createDataFrame([(bad,)], "t double").select(m.sleep_target(F.col("t"))).collect()


def test_recovery(spark):
    def run(hrv, rhr, asleep, n=8):
        rows_ = [("s", D0 + i, 42.0 if hrv else None, 55.0, 480.0, 480.0) for i in range(n)] + [("s", D0 + n, hrv, rhr, asleep, 480.0)]
        df = spark.createDataFrame(rows_, "sid string, day bigint, hrv double, rhr double, asleep double, target double")
        return at(m.recovery(df, "sid", hrv="hrv", rhr="rhr", asleep="asleep", target="target"), D0 + n, "score", "status", "z_rhr")

    assert run(42.0, 55.0, 480.0) == (74.0, "VALID", 0.0)
    assert run(None, 55.0, 480.0)[:2] == (74.0, "REDUCED")
    assert run(None, 52.0, 480.0)[2] == 2.0  # the sd has a floor
    assert run(None, None, 480.0)[:2] == (None, "INSUFFICIENT_DATA")
    assert run(None, 55.0, 480.0, 3)[:2] == (None, "CALIBRATING")


def test_watch(spark):
    """Three signals; rules and statuses as published: REDUCED where judged, else by how many were measured."""
    names = [f"{k}{c}" for k in ("rhr", "respiratory", "spo2") for c in ("", "_mean", "_sd")]
    cases = {
        1: ((66.0, 60.0, 0.0), (18.0, 16.0, 0.0), (97.0, 97.0, 1.0)), 2: ((65.0, 60.0, 0.0), (18.0, 16.0, 0.0), (91.9, 97.0, 1.0)), 3: ((70.0, 60.0, 4.0), (16.0, None, None), (92.0, 97.0, 1.0)),
        4: ((70.0, 60.0, 4.0), (16.0, None, None), (95.0, None, None)), 5: ((70.0, 60.0, 4.0), (None, None, None), (None, None, None)), 6: ((65.0, 60.0, 0.0), (17.5, 16.0, 0.05), (91.0, 97.0, 1.0)),
    }
    df = spark.createDataFrame([("s", d, *a, *b, *c) for d, (a, b, c) in cases.items()], "sid string, day bigint, " + ", ".join(f"{n} double" for n in names))
    got = {r["day"]: (r["ready_signals"], r["drivers"], r["watch"], r["status"]) for r in m.watch(df, "sid").collect()}
    assert got == {
        1: (3, "respiratory,rhr", True, "REDUCED"), 2: (3, "respiratory,spo2", True, "REDUCED"), 3: (2, "rhr", False, "REDUCED"), 4: (1, None, None, "CALIBRATING"), 5: (1, None, None, "INSUFFICIENT_DATA"), 6: (3, "spo2", False, "REDUCED"),
    }


def test_concern(spark):
    df = spark.createDataFrame([(x,) for x in ("BELOW", "ABOVE", "IN_RANGE", "STALE", "NO_DATA", "CALIBRATING")], "s string")
    flags = lambda k: [r[0] for r in df.select(m.concern(F.col("s"), k)).collect()]
    assert flags("rhr") == flags("respiratory") == [False, True, False, None, None, None] and flags("spo2") == [True, False, False, None, None, None]


def test_cusum(spark):
    series = [55 + 2 * math.sin(i) for i in range(30)] + [65] * 5 + [55] * 12
    c = m.cusum(frame(spark, series), "sid", "v")
    states = [r["state"] for r in c.orderBy("day").collect()]
    assert "RED" in states[30:35] and states[-1] == "GREEN" and set(states[:7]) == {"UNEVALUATED"}
    assert {r[0] for r in m.cusum(frame(spark, [60] * 40), "sid", "v").select("state").collect()} == {"UNEVALUATED"}
    gap = m.cusum(frame(spark, series[:33] + [None] * 3 + series[33:]), "sid", "v")
    assert {r["state"] for r in gap.filter(F.col("day").between(D0 + 33, D0 + 40)).collect()} == {"UNEVALUATED"}


@pytest.mark.parametrize("cut", [5, 31, 33, 40])
def test_change_points_go_on_from_a_token(spark, cut):
    series = [55 + 2 * math.sin(i) for i in range(30)] + [65] * 5 + [55] * 12
    z = m.cusum_z(frame(spark, series), "sid", "v")
    whole = m.cusum_fold(z, "sid")
    token = whole.filter(F.col("day") < D0 + cut).groupBy("sid").agg(F.max_by(F.struct("total", "alarms", "calm", "last"), "day").alias("x")).select("sid", "x.*")
    rest = m.cusum_fold(z.filter(F.col("day") >= D0 + cut), "sid", start=token)
    assert rows(rest, "day", "state", "total", "alarms", "calm", "last") == rows(whole.filter(F.col("day") >= D0 + cut), "day", "state", "total", "alarms", "calm", "last")


# features


def night_inputs(spark, stages, hrv=None):
    s = spark.createDataFrame([("s", "n1", 0, 28800, 0, 480.0, 1, 0, 16.0), ("s", "nap", 40000, 45000, 0, 80.0, 0, 1, None), ("s", "other", 100, 28000, 0, 400.0, 0, 0, None)], "sid string, source_record_id string, s bigint, t bigint, off int, duration_minutes double, has_stages int, is_nap_inferred int, respiratory double")
    st_ = spark.createDataFrame([("n1", i, k, a, b) for i, (k, a, b) in enumerate(stages)], "source_record_id string, stage_index int, stage string, start bigint, end bigint")
    hr = spark.createDataFrame([("s", t, 60.0) for t in range(0, 28800, 60)] + [("s", 30, 250.0), ("s", 28800, 40.0)], "sid string, ts bigint, bpm double")
    rhr = spark.createDataFrame([("s", 0, 55.0)], "sid string, day bigint, rhr double")
    o2 = spark.createDataFrame([("s", t, 97.0) for t in range(0, 28800, 600)] + [("s", 5, 0.0)], "sid string, ts bigint, value double")
    given = None if hrv is None else spark.createDataFrame([("s", "n1", hrv)], "sid string, source_record_id string, value double")
    return f.nightly(s, st_, hr, rhr, o2, given)


def table(spark, nights, *dailies):
    from signalframe.plans import metric_table as t

    days = spark.createDataFrame(list(dailies), "sid string, day bigint, rhr double, steps bigint, stress_median double, fingerprint string")
    return t.metric_table(nights, days, spark.createDataFrame([], "sid string, field string, value double, effective_from bigint, effective_to bigint"))


WHOLE = [("deep", 0, 10800), ("light", 10800, 19800), ("awake", 19800, 21600), ("rem", 21600, 28800)]


def test_nightly_feature(spark):
    n = night_inputs(spark, WHOLE).first()
    assert (n["source_record_id"], n["tib"], n["tst"], n["efficiency"], n["waso"], n["awakenings"], n["night_rhr"], n["hr_minutes"], n["rhr"], n["spo2_mean"], n["respiratory"], n["flags"]) == ("n1", 480.0, 450.0, 93.75, 30.0, [30.0], 60.0, 480, 55.0, 97.0, 16.0, "VENDOR_DERIVED")
    got = {r["metric"]: (r["value"], r["status"]) for r in table(spark, night_inputs(spark, WHOLE)).collect()}
    assert got["sleep.efficiency_pct"] == (93.75, "VALID") and got["respiratory.nightly_mean"] == (16.0, "REDUCED") and got["sleep.deep_pct"] == (40.0, "VALID") and got["rhr.vendor_daily"] == (55.0, "VALID")


@pytest.mark.parametrize("stages", [WHOLE[:-1], [*WHOLE[:2], ("light", 19000, 21600), WHOLE[3]], [("core", 0, 28800)], [*WHOLE[:2], WHOLE[3]], [("deep", 0, 28900)], []])
def test_incomplete_stages_are_no_stages(spark, stages):
    n = night_inputs(spark, stages).first()
    assert n["tst"] is None and n["waso"] is None and n["tib"] == 480.0 and "STAGE_INCOMPLETE" in n["flags"]


def test_daily_feature(spark):
    days = spark.createDataFrame([("s", 0, 0), ("s", 1, 5)], "sid string, day bigint, steps bigint")
    hr = spark.createDataFrame([("s", 0, 0, 60.0), ("s", 0, 30, 61.0), ("s", 0, 600, 60.0), ("s", 0, 900, 300.0)], "sid string, day bigint, ts bigint, bpm double")
    stress = spark.createDataFrame([("s", 0, 0, 12.0)], "sid string, day bigint, ts bigint, value double")
    o2 = spark.createDataFrame([("s", 0, t, v) for t, v in ((0, 97.0), (5, 96.0), (70, 95.0), (80, 0.0), (90, 101.0))], "sid string, day bigint, ts bigint, value double")
    got = {r["day"]: (r["steps"], r["hr_minutes"], r["hr_max_gap_min"], r["stress_median"], r["stress_p10"], r["distance"], r["spo2_samples"], r["spo2_minutes"]) for r in f.daily(days, hr, stress, o2).collect()}
    assert got == {0: (0, 2, 10, 12.0, 12.0, None, 3, 2), 1: (5, 0, None, None, None, None, 0, 0)}


def test_every_metric_is_in_the_table(spark):
    nights = night_inputs(spark, WHOLE)
    t = table(spark, nights, ("s", 0, 55.0, 100, 12.0, "x"))
    names = {r["metric"] for r in t.collect()}
    assert len(names) == 57 == t.count() and {"trend.stress_vendor.90d.theilsen", "health_signal.physiological_watch", "anomaly.rhr_cusum", "sleep.regularity"} <= names
    assert table(spark, nights).count() == 57 - 9 - 3  # no daily series: no trends of three, no baseline of one
    assert t.filter("n_inputs > 0 and (inputs_hash is null or last_input is null)").count() == 0 and t.filter("length(metadata) >= 500").count() == 0


def test_measured_variability(spark):
    n = night_inputs(spark, WHOLE, 42.0).first()
    assert (n["rmssd"], round(n["ln_rmssd"], 6)) == (42.0, round(math.log(42), 6)) and n["fingerprint"] != night_inputs(spark, WHOLE).first()["fingerprint"]
    with pytest.raises(Exception):  # noqa: B017
        night_inputs(spark, WHOLE, 0.0).collect()


def test_fingerprints_follow_the_inputs(spark):
    a, b = night_inputs(spark, WHOLE).first(), night_inputs(spark, WHOLE[:-1]).first()
    assert a["fingerprint"] == night_inputs(spark, WHOLE).first()["fingerprint"] != b["fingerprint"] and a["n_sources"] == 1 + 4 + 481 + 48
