"""Dated metrics of one subject's series: bands, trends, regularity, sleep score and debt, recovery, watch, change points.

Every function maps DataFrames with an entity column, an integer ``day`` and values to DataFrames; thresholds are
parameters whose defaults are the published rules' constants. Windows are calendar ranges, so nothing looks ahead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import logistic
from . import statistics as st
from .windows import calendar, max_gap, series_in


@dataclass(frozen=True)
class Band:
    """How wide a personal band is: at least ``floor`` on each side; ``lowest`` bounds it below; ``above`` is a side or not."""

    floor: float
    lowest: float | None = None
    above: bool = True
    sigmas: float = 1.65


#: The bands of the signals.
BANDS = {"rhr": Band(3.0), "spo2": Band(1.5, lowest=90.0, above=False), "respiratory": Band(0.8)}


def bands(series: DataFrame, by: str, value: str, band: Band, *, days: int = 30, least: int = 5, stale: int = 14) -> DataFrame:
    """Personal band of the days before, deviation and state of each observation; the day itself never counts.

    States in this order: NO_DATA, STALE (last observation of the window too old), CALIBRATING (too few), BELOW, ABOVE,
    IN_RANGE; a value on a bound is in range. Observations before the window count for nothing.
    """
    s = series.select(by, "day", F.col(value).cast("double").alias("v"))
    for step in band_columns("v", by, band, days=days, least=least, stale=stale):
        s = s.withColumns(step)
    s = s.withColumn("deviation", F.when(F.col("ready"), F.col("v") - F.col("mean")))
    return s.withColumn("state", band_state(F.col("v"), stale=stale))


def band_columns(value: str, by: str, band: Band, *, days: int = 30, least: int = 5, stale: int = 14, prefix: str = "") -> list[dict[str, Column]]:
    """Columns to add, step by step, to rows of (by, day) with ``value``: n, mean, sd, last_day; ready; lower and upper of the band."""
    w, p = calendar([by], "day", -days, -1), lambda c: f"{prefix}{c}"
    c = lambda name: F.col(p(name))
    half = F.greatest(c("sd") * band.sigmas, F.lit(band.floor))
    low = c("mean") - half if band.lowest is None else F.greatest(F.lit(band.lowest), c("mean") - half)
    return [
        {p("n"): F.count(value).over(w), p("mean"): F.avg(value).over(w), p("sd"): F.stddev_pop(value).over(w), p("last_day"): F.max(F.when(F.col(value).isNotNull(), F.col("day"))).over(w)},
        {p("ready"): F.coalesce((c("n") >= least) & (F.col("day") - c("last_day") <= stale), F.lit(False))},
        {p("lower"): F.when(c("ready"), low), p("upper"): F.when(c("ready"), c("mean") + half) if band.above else F.lit(None).cast("double")},
    ]


def band_state(value: Column, *, prefix: str = "", stale: int = 14) -> Column:
    """State of a value against the band in the columns of ``band_columns``."""
    c = lambda name: F.col(f"{prefix}{name}")
    return (
        F.when(value.isNull(), "NO_DATA").when(F.col("day") - c("last_day") > stale, "STALE").when(~F.coalesce(c("ready"), F.lit(False)), "CALIBRATING")
        .when(value < c("lower"), "BELOW").when(value > c("upper"), "ABOVE").otherwise("IN_RANGE")
    )


#: On which side of its band a signal is concerning.
CONCERNING = {"rhr": "ABOVE", "spo2": "BELOW", "respiratory": "ABOVE"}


def concern(state: Column, signal: str) -> Column:
    """Whether a state is concerning; null where the value can't be judged."""
    return F.when(state.isin("BELOW", "ABOVE", "IN_RANGE"), state == CONCERNING[signal])


def ewmas(series: DataFrame, by: str, value: str, *, days: int = 30, least: int = 5, stale: int = 14) -> DataFrame:
    """Exponentially weighted mean of the observations of the days before, oldest first; null where there are too few or old ones."""
    s = series.select(by, "day", F.col(value).cast("double").alias("v")).filter("v is not null").withColumn("prior", series_in(calendar([by], "day", -days, -1), "day", "v"))
    ready = F.when(F.size("prior") >= least, F.col("day") - F.element_at("prior", -1)["d"] <= stale)
    return s.select(by, "day", F.size("prior").cast("bigint").alias("n"), F.when(ready, st.ewma(F.transform("prior", lambda p: p["v"]))).alias("ewma"))


#: Calendar days of the trends, and the observations each needs.
TREND_WINDOWS = ((14, 7), (30, 14), (90, 30))


def trends(series: DataFrame, by: list[str], value: str, *, windows: tuple[tuple[int, int], ...] = TREND_WINDOWS, least_share: float = 0.6, widest_gap: int = 7, shard: int = 366, mark: str | None = None) -> DataFrame:
    """(by..., day, window_days, n, max_gap, marks, per_week): Theil-Sen slope per week over each calendar window that ends with an observation.

    The slope is null where a window has too few days or too wide a gap. Days are sorted once, within shards of about a
    year that begin with the days before it that their windows reach, and the slopes of many windows are found at once.
    ``value`` has one row a day; rows without value or ``by`` don't count. ``marks`` is the exclusive or of the integers
    ``mark`` of a window's rows (null without one).
    """
    reach = max(w for w, _ in windows) - 1
    s = series.select(*by, F.col("day").cast("bigint").alias("day"), F.col(value).cast("double").alias("v"), (F.lit(0) if mark is None else F.col(mark)).cast("bigint").alias("mark")).dropna()
    own = F.floor(F.col("day") / shard)
    last = F.floor((F.col("day") + reach) / shard)
    s = s.select("*", own.alias("own"), F.explode(F.sequence(own, last)).alias("shard")).withColumn("shown", F.col("own") == F.col("shard"))
    s = s.select(*by, "shard", "day", "v", "mark", "shown").repartition(*by, "shard").sortWithinPartitions(*by, "shard", "day")
    kinds = ", ".join(f"`{c}` {series.schema[c].dataType.simpleString()}" for c in by)
    return s.mapInArrow(st.theil_sen_windows(len(by), windows, least_share, widest_gap), f"{kinds}, day bigint, window_days int, n bigint, max_gap bigint, marks bigint, per_week double")


def regularity(nights: DataFrame, by: str, bed: str, wake: str, *, complete: str | None = None, days: int = 14, least: int = 5) -> DataFrame:
    """0 to 100 from the circular spread of bed and wake clock minutes over the last nights; CALIBRATING with too few.

    With ``complete`` only nights for which it is true count, and have a row.
    """
    nights = nights if complete is None else nights.filter(F.col(complete))
    w = calendar([by], "day", -(days - 1), 0)
    whole = F.col(bed).isNotNull() & F.col(wake).isNotNull()
    given = nights.select(by, "day", F.when(whole, F.col(bed)).alias("bed"), F.when(whole, F.col(wake)).alias("wake"))
    sums = {f"{c}_{g.__name__}": F.sum(g(st.angle(F.col(c)))).over(w) for c in ("bed", "wake") for g in (F.sin, F.cos)}
    n = given.select(by, "day", F.collect_list("bed").over(w).alias("beds"), F.collect_list("wake").over(w).alias("wakes"), *[v.alias(k) for k, v in sums.items()])
    spread = lambda c: st.circular_sd(F.col(f"{c}s"), st.circular_mean(F.col(f"{c}_sin"), F.col(f"{c}_cos")))
    sigma = (spread("bed") + spread("wake")) / 2
    n = n.withColumns({"n": F.size("beds"), "sigma": sigma})
    ready = F.col("n") >= least
    score = F.rint(100.0 * (1 - F.least(F.greatest(F.col("sigma") - 20, F.lit(0.0)), F.lit(100.0)) / 100))
    return n.select(by, "day", F.col("n").cast("bigint").alias("n"), F.when(ready, F.col("sigma")).alias("sigma"), F.when(ready, score).alias("regularity"), F.when(ready, "VALID").otherwise("CALIBRATING").alias("status"))


def _falling(x: Column, k: float, midpoint: float, anchor: float) -> Column:
    """Logistic curve that is 100 at the anchor."""
    return F.lit(100.0) * (1 + F.exp(F.lit(k * (anchor - midpoint)))) / (1 + F.exp(F.least(F.lit(709.0), (x - midpoint) * k)))


def sleep_score(nights: DataFrame, by: str, *, history: int = 14, least: int = 5) -> DataFrame:
    """Four-part sleep score of nights (tst, deep, rem, waso, bedtime in minutes; awakenings: array of minutes; complete).

    Parts are cut to whole points toward zero, also their weighted sum. Without stages or parts: INSUFFICIENT_DATA; with
    fewer than ``least`` earlier bedtimes in ``history`` days: CALIBRATING; impossible parts: INVALID.
    """
    noon = lambda m: F.when(m / 60 < 12, m / 60 + 12).otherwise(m / 60 - 12)
    w = calendar([by], "day", -history, -1)
    n = nights.withColumn("prior", F.collect_list(F.when(F.col("bedtime").between(0, 1439.999999), noon(F.col("bedtime")))).over(w))
    hours = F.col("tst") / 60
    whole = lambda c: c.cast("bigint")
    bound = lambda c, low: F.greatest(F.lit(low), F.least(F.lit(100), c))
    duration = F.when(hours.between(7, 9), 100).when(hours < 7, bound(whole(_falling(hours, -1.5, 5, 7)), 0)).otherwise(bound(whole(_falling(hours, 0.8, 11, 9)), 50))
    stages = whole((F.least(F.lit(100), whole(F.col("deep") / 90 * 100)) + F.least(F.lit(100), whole(F.col("rem") / 90 * 100))) * 0.5)
    diff = (noon(F.col("bedtime")) - st.array_median(F.col("prior"))) * 60
    late, early = (diff - 15) / 105 * 100, F.least(F.lit(20.0), (-diff - 15) / 105 * 100)
    consistency = F.greatest(F.lit(0), whole(100 - F.when(diff > 15, late).when(diff < -15, early).otherwise(0.0)))
    long_ones = F.least(F.size(F.filter("awakenings", lambda d: d > 5)), F.lit(4))
    points = F.when(F.col("waso") <= 20, 80.0).otherwise(F.greatest(F.lit(0.0), 80 - (F.col("waso") - 20) / 70 * 80)) + F.element_at(F.array(*map(F.lit, (20.0, 20.0, 15.0, 10.0, 0.0))), long_ones + 1)
    n = n.withColumns({"duration": duration.cast("bigint"), "stages": stages, "consistency": consistency, "interruptions": bound(whole(points), 0), "history": F.size("prior").cast("bigint")})
    given = F.coalesce(F.col("complete"), F.lit(False)) & F.col("tst").isNotNull() & F.col("deep").isNotNull() & F.col("rem").isNotNull() & F.col("waso").isNotNull() & F.col("awakenings").isNotNull()
    sane = (F.col("tst") > 0) & (F.col("deep") + F.col("rem") <= F.col("tst") + 1) & (F.col("deep") >= 0) & (F.col("rem") >= 0) & (F.col("waso") >= 0) & F.col("bedtime").between(0, 1439.999999)
    status = F.when(~given, "INSUFFICIENT_DATA").when(F.col("history") < least, "CALIBRATING").when(sane, "VALID").otherwise("INVALID")
    total = whole(F.col("duration") * 0.4 + F.col("stages") * 0.2 + F.col("consistency") * 0.2 + F.col("interruptions") * 0.2)
    valid = F.col("status") == "VALID"
    only = lambda c: F.when(valid, F.col(c)).alias(c)
    return n.withColumn("status", status).withColumn("score", F.when(valid, total)).select(by, "day", "status", "history", only("duration"), only("stages"), only("consistency"), only("interruptions"), "score")


#: Minutes of sleep that a target may ask for, and what is asked for without one.
TARGET_RANGE, DEFAULT_TARGET = (300.0, 720.0), 480.0


def sleep_target(given: Column) -> Column:
    """The target in force, the default without one; an error outside the range that a target may have."""
    wrong = ~given.between(*TARGET_RANGE) | F.isnan(given)
    return F.when(given.isNull(), DEFAULT_TARGET).when(wrong, F.raise_error(F.lit("a sleep target must be within 300 to 720 minutes")).cast("double")).otherwise(given)


def ledger(nights: DataFrame, by: str, days: int = 14) -> DataFrame:
    """(by, day, night): every calendar day of the ``days`` up to each night; ``night`` marks those with a row of their own."""
    w = Window.partitionBy(by).orderBy("day")
    before = F.lag("day").over(w)
    first = F.greatest(F.coalesce(before + 1, F.col("day") - days + 1), F.col("day") - days + 1)
    spans = nights.select(by, F.col("day").cast("bigint").alias("day")).distinct().withColumn("first", first)
    return spans.select(by, "day", F.explode(F.sequence("first", "day")).alias("at")).select(by, F.col("at").alias("day"), (F.col("at") == F.col("day")).alias("night"))


def sleep_debt(calendar_days: DataFrame, by: str, tst: str, target: str, default: str, *, days: int = 14, least: int = 10, longest_missing: int = 2) -> DataFrame:
    """Sleep missing over the last calendar nights against each night's own target; CALIBRATING with too few or too long without.

    ``calendar_days`` has the rows of ``ledger``, with ``tst`` (null without a complete night), ``target`` and ``default``
    (no target was given) of each day, also those without a night. One row for each night.
    """
    w = calendar([by], "day", -(days - 1), 0)
    n = calendar_days.withColumn("v", F.when((F.col(tst) > 0) & (F.col(tst) <= 1440), F.col(tst) - F.col(target))).withColumn("p", series_in(w, "day", "v")).withColumn("any_default", F.max(F.col(default).cast("int")).over(w)).filter("night")
    inner = F.coalesce(max_gap(F.col("p")) - 1, F.lit(0))
    edge = F.greatest(F.element_at(F.col("p"), 1)["d"] - (F.col("day") - days + 1), F.col("day") - F.element_at(F.col("p"), -1)["d"])
    missing = F.when(F.size("p") > 0, F.greatest(inner, edge)).otherwise(days)
    n = n.withColumns({"n": F.size("p").cast("bigint"), "longest_missing": missing.cast("bigint")})
    ready = (F.col("n") >= least) & (F.col("longest_missing") <= longest_missing)
    balance = F.aggregate(F.transform("p", lambda x: x["v"]), F.lit(0.0), lambda a, v: a + v)
    status = F.when(~ready, "CALIBRATING").when(F.col("any_default") == 1, "REDUCED").otherwise("VALID")
    return n.select(by, "day", "n", "longest_missing", F.when(ready, F.greatest(F.lit(0.0), -balance)).alias("debt_min"), status.alias("status"))


#: Weights of the recovery components.
RECOVERY_WEIGHTS = {"hrv": 0.55, "rhr": 0.25, "sleep": 0.20}


def recovery(nights: DataFrame, by: str, *, hrv: str, rhr: str, asleep: str, target: str, days: int = 90, most: int = 30, least: int = 5, stale: int = 14) -> DataFrame:
    """0 to 100 from heart rate variability, resting heart rate and sleep against personal baselines.

    A baseline is the last ``most`` readings of the ``days`` before; it must have ``least`` readings, as many of them
    within 30 days, the last not older than ``stale`` days. Without variability both sleep and a ready rate are needed.
    """
    w = calendar([by], "day", -days, -1)
    n = nights.select(by, "day", *[F.col(c).cast("double").alias(a) for c, a in ((hrv, "hrv"), (rhr, "rhr"), (asleep, "asleep"), (target, "target"))])
    limits = {"hrv": (0.001, 10000.0), "rhr": (25.0, 240.0), "asleep": (0.001, 1440.0)}
    n = n.withColumns({k: F.when(F.col(k).between(*v) & ~F.isnan(k), F.col(k)) for k, v in limits.items()})
    n = n.withColumn("target", sleep_target(F.col("target")))
    for k in ("hrv", "rhr"):
        n = n.withColumn("p", series_in(w, "day", k)).withColumn("p", F.slice("p", F.greatest(F.size("p") - most + 1, F.lit(1)), F.lit(most)))
        values = F.transform("p", lambda x: x["v"])
        recent = F.size(F.filter("p", lambda x: x["d"] >= F.col("day") - 30))
        ok = (F.size("p") >= least) & (recent >= least) & (F.col("day") - F.element_at("p", -1)["d"] <= stale)
        ok = F.when(F.size("p") > 0, ok).otherwise(False)
        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size("p")
        n = n.withColumns({f"{k}_ready": ok, f"{k}_mean": F.when(ok, mean), f"{k}_sd": F.when(ok, st.array_sd(values))})
    z = {
        "hrv": (F.col("hrv") - F.col("hrv_mean")) / F.greatest(F.col("hrv_sd"), F.lit(3.0)),
        "rhr": (F.col("rhr_mean") - F.col("rhr")) / F.greatest(F.col("rhr_sd"), F.lit(1.5)),
        "sleep": (F.col("asleep") / F.col("target") - 1) / 0.12,
    }
    n = n.withColumns({f"z_{k}": v for k, v in z.items()})
    weight = lambda k: F.when(F.col(f"z_{k}").isNotNull(), F.lit(RECOVERY_WEIGHTS[k])).otherwise(0.0)
    total = weight("hrv") + weight("rhr") + weight("sleep")
    mixed = sum((F.coalesce(F.col(f"z_{k}"), F.lit(0.0)) * F.try_divide(weight(k), total) for k in z), F.lit(0.0))
    ready = F.col("z_hrv").isNotNull() | (F.col("z_rhr").isNotNull() & F.col("z_sleep").isNotNull())
    score = F.rint(100 * logistic(1.06 + 0.85 * mixed))
    full = F.col("z_hrv").isNotNull() & F.col("z_rhr").isNotNull() & F.col("z_sleep").isNotNull()
    waiting = (F.col("rhr").isNotNull() & ~F.col("rhr_ready")) | (F.col("hrv").isNotNull() & ~F.col("hrv_ready"))
    status = F.when(ready & full, "VALID").when(ready, "REDUCED").when(F.col("hrv").isNull() & F.col("asleep").isNull(), "INSUFFICIENT_DATA").when(waiting, "CALIBRATING").otherwise("INSUFFICIENT_DATA")
    return n.select(by, "day", "z_hrv", "z_rhr", "z_sleep", F.when(ready, score).alias("score"), status.alias("status"))


@dataclass(frozen=True)
class Driver:
    """When a signal is unusual: more than ``sigmas`` sds above its baseline (by ``step`` where the sd is under ``least_sd``), or under ``below``."""

    least_sd: float = 0.0
    step: float = 0.0
    below: float | None = None


#: The drivers of the watch.
DRIVERS = {"rhr": Driver(0.01, 5.0), "respiratory": Driver(0.1, 1.5), "spo2": Driver(below=92.0)}


def watch(signals: DataFrame, by: str, drivers: dict[str, Driver] = DRIVERS, *, sigmas: float = 1.5, least: int = 2) -> DataFrame:
    """Whether two signals or more are unusual together.

    ``signals`` has for each name its valid value (null if not measured), and ``_mean`` and ``_sd`` of its baseline (null
    if it can't be judged). With fewer than ``least`` judged signals there is no value: INSUFFICIENT_DATA if fewer were
    measured, else CALIBRATING. What is judged is REDUCED: parts of the rule's signals have no source.
    """
    def fired(k: str) -> Column:
        d = drivers[k]
        v, mean, sd = F.col(k), F.col(f"{k}_mean"), F.col(f"{k}_sd")
        unusual = v < d.below if d.below is not None else F.when(sd >= d.least_sd, (v - mean) / sd > sigmas).otherwise(v > mean + d.step)
        return F.when(v.isNotNull() & mean.isNotNull() & sd.isNotNull(), unusual)

    count = lambda cs: sum((c.cast("int") for c in cs), F.lit(0))
    ready, measured = count(fired(k).isNotNull() for k in drivers), count(F.col(k).isNotNull() for k in drivers)
    found = F.array_compact(F.array(*[F.when(fired(k), F.lit(k)) for k in sorted(drivers)]))
    enough = ready >= least
    status = F.when(enough, "REDUCED").when(measured < least, "INSUFFICIENT_DATA").otherwise("CALIBRATING")
    return signals.select(by, "day", ready.cast("bigint").alias("ready_signals"), F.when(enough, F.concat_ws(",", found)).alias("drivers"), F.when(enough, F.size(found) >= 2).alias("watch"), status.alias("status"))


@dataclass(frozen=True)
class Cusum:
    """A one-sided CUSUM: ``k`` is taken off each z, above ``h`` it alarms; two values under ``back`` in a row clear it, and a pause of more than ``pause`` days."""

    k: float = 0.5
    h: float = 4.0
    back: float = 0.5
    clear: int = 2
    pause: int = 1


def _folded(rule: Cusum):
    """What the CUSUM is after each night of rows sorted by entity and day; a row with ``start`` sets the state to go on from."""

    def step(state: tuple[float, int, int, int | None], day: int, z: float) -> tuple[float, int, int, int | None]:
        total, alarms, calm, last = state
        if last is None or day - last > rule.pause:
            total, alarms, calm = 0.0, 0, 0
        calm = calm + 1 if z < rule.back else 0
        total = 0.0 if calm >= rule.clear else max(0.0, total + z - rule.k)
        return total, alarms + 1 if total > rule.h else 0, calm, day

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity, state = None, (0.0, 0, 0, None)
        for b in batches:
            at, rows = [], []
            for i, (e, day, z, start) in enumerate(zip(b.column(0).to_pylist(), *(b.column(c).to_pylist() for c in ("day", "z", "start")), strict=True)):
                if e != entity:
                    entity, state = e, (0.0, 0, 0, None)
                if start is not None:
                    state = (start["total"], start["alarms"], start["calm"], start["last"])
                    continue
                if z is not None:
                    state = step(state, day, z)
                at.append(i)
                rows.append((state[0] if z is not None else None, "UNEVALUATED" if z is None else ("GREEN", "YELLOW", "RED")[min(state[1], 2)], *state))
            kept = b.drop_columns(["start"]).take(pa.array(at, pa.int64()))
            kinds = (pa.float64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]], names=[*kept.schema.names, "cusum", "state", "total", "alarms", "calm", "last"])

    return run


def cusum_z_columns(value: str, by: str, *, days: int = 28, least: int = 7, contiguous: int = 7, least_sd: float = 1.0) -> list[dict[str, Column]]:
    """Columns to add, step by step, to rows of (by, day) with ``value``; the last is ``z``."""
    w = calendar([by], "day", -days, -1)
    values = F.transform("z_prior", lambda x: x["v"])
    scale = F.when(F.col("z_mad") > 0, F.col("z_mad")).otherwise(F.col("z_sd"))
    evaluated = F.col(value).isNotNull() & (F.size("z_prior") >= least) & (F.col("z_run") >= contiguous) & (F.round("z_sd", 9) >= least_sd)
    return [
        {"z_prior": series_in(w, "day", value), "z_run": F.count(value).over(calendar([by], "day", -contiguous, -1)), "z_sd": F.stddev_samp(value).over(w)},
        {"z_median": F.when(F.size("z_prior") >= least, st.array_median(values))},
        {"z_mad": st.array_mad(values, F.col("z_median"))},
        {"z": F.when(evaluated, (F.col(value) - F.col("z_median")) / scale)},
    ]


def cusum_z(series: DataFrame, by: str, value: str, *, days: int = 28, least: int = 7, contiguous: int = 7, least_sd: float = 1.0) -> DataFrame:
    """(by, day, z): robust z of each night against the days before, null where it isn't evaluated.

    A night is evaluated if it has a value, ``least`` observations in the ``days`` before, one on each of the
    ``contiguous`` days before, and a spread of at least ``least_sd``.
    """
    s = series.select(by, F.col("day").cast("bigint").alias("day"), F.col(value).cast("double").alias("v"))
    for step in cusum_z_columns("v", by, days=days, least=least, contiguous=contiguous, least_sd=least_sd):
        s = s.withColumns(step)
    return s.select(by, "day", "z")


TOKEN = "struct<total:double,alarms:int,calm:int,last:bigint>"


def cusum_fold(z: DataFrame, by: str, *, rule: Cusum = Cusum(), start: DataFrame | None = None) -> DataFrame:
    """Rows of (by, day, z, further columns) with cusum, state, total, alarms, calm, last: the CUSUM after each night, and the token to go on from.

    Unevaluated nights keep the state. Above the threshold: YELLOW, again the next time: RED. ``start`` (by, total, alarms,
    calm, last) is the token of each subject's last night before these: the fold then gives what it would over all nights.
    A subject's nights go through one task in order, a few bytes each: the calendar bounds them.
    """
    rows = z.select(by, "day", "z", *[c for c in z.columns if c not in (by, "day", "z")]).withColumn("start", F.lit(None).cast(TOKEN))
    if start is not None:
        token = F.struct(F.col("total").cast("double").alias("total"), F.col("alarms").cast("int").alias("alarms"), F.col("calm").cast("int").alias("calm"), F.col("last").cast("bigint").alias("last"))
        rows = rows.unionByName(start.select(by, F.lit(-(1 << 62)).alias("day"), F.lit(None).cast("double").alias("z"), token.alias("start")), allowMissingColumns=True)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns if c != "start")
    return rows.repartition(by).sortWithinPartitions(by, "day").mapInArrow(_folded(rule), f"{kinds}, cusum double, state string, total double, alarms int, calm int, last bigint")


def cusum(series: DataFrame, by: str, value: str, **options) -> DataFrame:
    """Change points of a nightly series: ``cusum_fold`` of ``cusum_z``."""
    return cusum_fold(cusum_z(series, by, value, **options), by)
