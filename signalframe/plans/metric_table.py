"""All dated metrics of the subjects as one long table: one row for each subject, day and metric.

Features are one row a subject and day, so that the calendar bounds a subject's rows. What depends on neighbouring days is
computed in one frame whose windows all have the same order (one shuffle, one sort); only slopes, the sleep ledger and the
change points have passes of their own. A row has value, unit, status, confidence, origin, algorithm and version, and its
lineage: number, hash and first and last day of the feature rows it was computed from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite_between
from ..operators import metrics as m
from ..operators import statistics as st
from ..operators.joins import effective
from ..operators.windows import calendar, series_in
from .features import ASLEEP, STAGES

#: What the metrics are computed by; a change of a version makes new revisions of its metrics.
VERSIONS = {"foundations": "3", "sleep": "2", "recovery": "2", "monitoring": "3"}
#: The series of baselines and trends, the feature and column of each, limits of valid values, and the unit.
SERIES = {
    "rhr": ("daily", "rhr", 25.0, 240.0, "bpm"), "sleep_tst": ("night", "tst", 0.0, None, "min"), "spo2": ("night", "spo2_mean", 1e-9, 100.0, "%"), "respiratory": ("night", "respiratory", 4.0, 60.0, "breaths/min"),
    "steps": ("daily", "steps", 0.0, None, "steps"), "stress_vendor": ("daily", "stress_median", None, None, "vendor_scale"),
}
BASELINES = ("rhr", "sleep_tst", "spo2", "respiratory")
#: Metrics whose source is a device's own aggregate are never more than REDUCED.
REDUCED = ("respiratory", "stress_vendor")
SCHEMA = "sid string, day bigint, metric string, value double, unit string, status string, confidence string, origin string, algorithm string, version string, n_inputs bigint, inputs_hash string, first_input bigint, last_input bigint, metadata string"


def _metric(name: str, value: Column, unit: str, status: Column, algorithm: str, family: str, lineage: Column, *, confidence: Column | str = "MEDIUM", origin: str = "OUR_DERIVED", **metadata: Column) -> Column:
    notes = F.to_json(F.struct(*[v.alias(k) for k, v in metadata.items()])) if metadata else F.lit("{}")
    return F.struct(
        F.lit(name).alias("metric"), value.cast("double").alias("value"), F.lit(unit).alias("unit"), status.alias("status"), (F.lit(confidence) if isinstance(confidence, str) else confidence).alias("confidence"),
        F.lit(origin).alias("origin"), F.lit(algorithm).alias("algorithm"), F.lit(VERSIONS[family]).alias("version"), lineage.alias("lineage"), notes.alias("metadata"),
    )


def _lineage(n: Column, marks: Column, first: Column, last: Column) -> Column:
    return F.struct(F.coalesce(n, F.lit(0)).cast("bigint").alias("n_inputs"), F.hex(F.coalesce(marks, F.lit(0))).alias("inputs_hash"), first.cast("bigint").alias("first_input"), last.cast("bigint").alias("last_input"))


def _one(mark: str) -> Column:
    there = F.col(mark).isNotNull()
    return _lineage(there.cast("int"), F.col(mark), F.when(there, F.col("day")), F.when(there, F.col("day")))


def _over(mark: str, first: int, last: int) -> Column:
    """Lineage from the rows with a mark in a calendar window."""
    w, there = calendar(["sid"], "day", first, last), F.when(F.col(mark).isNotNull(), F.col("day"))
    return _lineage(F.count(mark).over(w), F.bit_xor(mark).over(w), F.min(there).over(w), F.max(there).over(w))


def _with(a: Column, b: Column) -> Column:
    """Lineage ``b`` with the row of the day itself added."""
    marks = F.conv(a["inputs_hash"], 16, -10).cast("bigint").bitwiseXOR(F.conv(b["inputs_hash"], 16, -10).cast("bigint"))
    return _lineage(a["n_inputs"] + b["n_inputs"], marks, F.least(a["first_input"], b["first_input"]), F.greatest(a["last_input"], b["last_input"]))


def _long(rows: DataFrame, metrics: list[Column]) -> DataFrame:
    x = rows.select("sid", "day", F.explode(F.array_compact(F.array(*metrics))).alias("m")).select("sid", "day", "m.*")
    return x.select("sid", "day", "metric", "value", "unit", "status", "confidence", "origin", "algorithm", "version", "lineage.*", "metadata")


def _status(value: Column, otherwise: str, found: str = "VALID") -> Column:
    return F.when(value.isNotNull(), found).otherwise(otherwise)


def frame(nights: DataFrame, dailies: DataFrame, profile: DataFrame) -> DataFrame:
    """One row for each subject and day with a night or a summary: both features, the series, and the sleep target in force."""
    n = nights.select("sid", F.col("day").cast("bigint").alias("day"), F.lit(True).alias("night"), *[F.col(c).alias(f"n_{c}") for c in nights.columns if c not in ("sid", "day")])
    d = dailies.select("sid", F.col("day").cast("bigint").alias("day"), *[F.col(c).alias(f"d_{c}") for c in ("rhr", "steps", "stress_median", "fingerprint")])
    both = n.join(d, ["sid", "day"], "full_outer").withColumns({"night": F.coalesce("night", F.lit(False)), "n_mark": F.when(F.col("n_fingerprint").isNotNull(), F.xxhash64("n_fingerprint")), "d_mark": F.when(F.col("d_fingerprint").isNotNull(), F.xxhash64("d_fingerprint"))})
    series = {}
    for key, (kind, column, low, high, _) in SERIES.items():
        v = F.col(f"{kind[0]}_{column}").cast("double")
        ok = ~F.isnan(v) & (F.abs(v) < float("inf"))
        ok = ok if low is None else ok & (v >= low)
        series[key] = F.when(ok if high is None else ok & (v <= high), v)
    both = both.withColumns(series).withColumns({f"{k}_mark": F.when(F.col(k).isNotNull(), F.col(f"{SERIES[k][0][0]}_mark")) for k in SERIES})
    return effective(both, profile.filter("field = 'sleep_target_min'"), ["sid"], "sleep_target_min", "day")


def direct(f: DataFrame) -> DataFrame:
    """What a night or a summary gives by itself.

    Stage minutes count only if all are there and add up; the time in bed survives. The rate of the day has no row where
    neither feature has one; others have a row with a null value and INSUFFICIENT_DATA.
    """
    n = lambda c: F.col(f"n_{c}")
    minutes = {c: finite_between(n(c), 0, 1440) for c in ("tib", "tst", *STAGES)}
    f = f.withColumns({f"m_{k}": v for k, v in minutes.items()})
    t, tib = F.col("m_tst"), F.col("m_tib")
    sound = n("complete") & F.coalesce(F.greatest(*[F.col(f"m_{k}").isNull() for k in STAGES]) == F.lit(False), F.lit(False)) & F.coalesce((t <= tib + 1) & (F.abs(t + F.col("m_awake") - tib) <= 1), F.lit(True))
    f = f.withColumns({f"m_{k}": F.when(sound, F.col(f"m_{k}")) for k in ("tst", *STAGES)})
    lacking, here = "INSUFFICIENT_DATA", _one("n_mark")

    def percent(part: Column, whole: Column) -> Column:
        """100 is kept although sums of minutes are a little more than their parts now and then."""
        p = finite_between(F.try_divide(part * 100, F.when(whole > 0, whole)), 0, 100 + 1e-9)
        return F.when(p > 100, 100.0).otherwise(p)

    def row(name: str, value: Column, unit: str, algorithm: str, found: str = "VALID", **more) -> Column:
        return F.when(F.col("night"), _metric(name, value, unit, _status(value, lacking, found), algorithm, "foundations", here, **more))

    rate = F.coalesce(F.col("rhr"), finite_between(n("rhr"), 25, 240))
    low = {"confidence": "LOW"}
    rows = [
        row("rhr.nightly", finite_between(n("night_rhr"), 25, 240), "bpm", "rhr.lowest_window_mean", measured_minutes=n("hr_minutes")),
        row("sleep.time_in_bed_min", tib, "min", "sleep.session_span"),
        row("sleep.total_sleep_time_min", t, "min", "sleep.stage_duration"),
        *[row(f"sleep.{k}_min", F.col(f"m_{k}"), "min", "sleep.stage_duration") for k in STAGES],
        row("sleep.efficiency_pct", finite_between(F.try_divide(F.col("m_tst") * 100, F.when(tib > 0, tib)), 0, 100.1), "%", "sleep.tst_over_tib"),
        *[row(f"sleep.{k}_pct", percent(F.col(f"m_{k}"), F.col("m_tst")), "%", "sleep.stage_share") for k in ASLEEP],
        row("sleep.awake_pct", percent(F.col("m_awake"), tib), "%", "sleep.stage_share"),
        row("spo2.nightly_count", n("spo2_samples").cast("double"), "samples", "spo2.observed_count", confidence="HIGH"),
        row("spo2.nightly_span_min", finite_between(n("spo2_span_min"), 0, float("inf")), "min", "spo2.observed_span"),
        *[row(f"spo2.nightly_{k}", finite_between(n(f"spo2_{k}"), 0, 100), "%", "spo2.night_distribution", confidence="MEDIUM" if k == "mean" else "LOW", sample_count=n("spo2_samples"), required_samples=F.lit(least), span_min=n("spo2_span_min")) for k, least in (("mean", 6), ("min", 12), ("p10", 12))],
        row("respiratory.nightly_mean", finite_between(n("respiratory"), 4, 60), "breaths/min", "respiratory.vendor_night_mean", "REDUCED", origin="VENDOR_DERIVED", **low),
        F.when(rate.isNotNull(), _metric("rhr.vendor_daily", rate, "bpm", F.lit("VALID"), "rhr.vendor_daily", "foundations", F.when(F.col("rhr").isNotNull(), _one("d_mark")).otherwise(here), origin="VENDOR_DERIVED")),
    ]
    return _long(f, rows)


def baselines(f: DataFrame) -> DataFrame:
    """Bands, deviations and exponentially weighted means of the days before, for days that have a value."""
    rows = []
    for key in BASELINES:
        unit, found = SERIES[key][4], "REDUCED" if key in REDUCED else "VALID"
        f = f.withColumn(f"{key}_used", _over(f"{key}_mark", -30, -1))
        used = _with(_one(f"{key}_mark"), F.col(f"{key}_used"))
        # a series without a band has its readiness from the same columns
        for step in m.band_columns(key, "sid", m.BANDS.get(key, m.Band(0.0)), prefix=f"{key}_"):
            f = f.withColumns(step)
        c = lambda name, key=key: F.col(f"{key}_{name}")
        f = f.withColumn(f"{key}_prior", series_in(calendar(["sid"], "day", -30, -1), "day", key))
        there, notes = F.col(key).isNotNull(), {"history_count": c("n"), "last_prior_day": c("last_day")}
        mean, level = F.when(c("ready"), c("mean")), F.when(c("ready"), st.ewma(F.transform(c("prior"), lambda p: p["v"])))
        if key in m.BANDS:
            sure = F.when(c("ready"), "MEDIUM").otherwise("LOW")
            rows += [
                F.when(there, _metric(f"baseline.{key}.band_mean", mean, unit, _status(mean, "CALIBRATING", found), f"baseline.{key}_band", "foundations", used, confidence=sure, **notes, sd=F.when(c("ready"), c("sd")), lower=c("lower"), upper=c("upper"))),
                F.when(there, _metric(f"{key}.deviation", F.col(key) - mean, unit, _status(mean, "CALIBRATING", found), f"deviation.{key}", "foundations", used, **notes)),
            ]
        rows.append(F.when(there, _metric(f"baseline.{key}.ewma", level, unit, _status(level, "CALIBRATING", found), f"baseline.ewma30_{key}", "foundations", used, **notes)))
    return _long(f, rows)


def trends(f: DataFrame) -> DataFrame:
    """Robust weekly slopes of all series over 14, 30 and 90 days, for days that have a value."""
    pairs = F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(k).alias("key"), F.col(k).alias("v"), F.col(f"{k}_mark").alias("mark"))) for k in SERIES])
    series = f.select("sid", "day", F.explode(F.array_compact(pairs)).alias("x")).select("sid", "x.key", "day", "x.v", "x.mark")
    slopes = m.trends(series, ["sid", "key"], "v", mark="mark")
    reduced = F.when(F.col("key").isin(*REDUCED), "REDUCED").otherwise("VALID")
    units = F.create_map(*[F.lit(x) for k, v in SERIES.items() for x in (k, f"{v[4]}/week")])
    return slopes.select(
        "sid", "day", F.concat(F.lit("trend."), "key", F.lit("."), F.col("window_days").cast("string"), F.lit("d.theilsen")).alias("metric"), F.col("per_week").alias("value"), units[F.col("key")].alias("unit"),
        F.when(F.col("per_week").isNotNull(), reduced).otherwise("CALIBRATING").alias("status"), F.when(F.col("per_week").isNotNull(), "MEDIUM").otherwise("LOW").alias("confidence"), F.lit("OUR_DERIVED").alias("origin"), F.lit("trend.theil_sen_calendar").alias("algorithm"),
        F.lit(VERSIONS["foundations"]).alias("version"), F.col("n").alias("n_inputs"), F.hex("marks").alias("inputs_hash"), F.lit(None).cast("bigint").alias("first_input"), F.col("day").alias("last_input"),
        F.to_json(F.struct(F.col("window_days"), F.col("n").alias("history_count"), F.col("max_gap").alias("max_gap_days"))).alias("metadata"),
    )


def regularity(f: DataFrame) -> DataFrame:
    n = f.filter("night and n_complete").select("sid", "day", "n_bedtime", "n_wake", F.when(F.col("n_bedtime").isNotNull() & F.col("n_wake").isNotNull(), F.col("n_mark")).alias("mark")).withColumn("used", _over("mark", -13, 0))
    r = m.regularity(n, "sid", "n_bedtime", "n_wake").join(n.select("sid", "day", "used"), ["sid", "day"])
    sure = F.when(F.col("regularity").isNotNull(), "MEDIUM").otherwise("LOW")
    return _long(r, [_metric("sleep.regularity", F.col("regularity"), "score_0_100", F.col("status"), "sleep.circular_consistency", "foundations", F.col("used"), confidence=sure, history_count=F.col("n"), combined_sd_min=F.col("sigma"))])


def sleep(f: DataFrame, profile: DataFrame) -> DataFrame:
    """Score, need and debt of each night."""
    n = f.filter("night")
    given = n.select("sid", "day", *[F.col(f"n_{c}").alias(c) for c in ("tst", "deep", "rem", "waso", "bedtime", "awakenings", "complete")])
    lived = n.select("sid", "day", "n_mark", "sleep_target_min", F.when(F.col("n_bedtime").between(0, 1439.999999), F.col("n_mark")).alias("bed_mark"))
    lived = lived.withColumn("used", _with(_one("n_mark"), _over("bed_mark", -14, -1)))
    score = m.sleep_score(given, "sid").join(lived, ["sid", "day"])
    target, default = m.sleep_target(F.col("sleep_target_min")), F.col("sleep_target_min").isNull()
    rows = [
        _metric("sleep.score", F.col("score"), "score", F.col("status"), "sleep.four_parts", "sleep", F.col("used"), history_count=F.col("history"), duration=F.col("duration"), stages=F.col("stages"), consistency=F.col("consistency"), interruptions=F.col("interruptions")),
        _metric("sleep.need_min", target, "min", F.when(default, "REDUCED").otherwise("VALID"), "sleep.fixed_target", "sleep", _one("n_mark"), default_target=default),
    ]
    slept = n.select("sid", "day", F.when(F.col("n_complete"), finite_between(F.col("n_tst"), 0.001, 1440)).alias("tst"), "n_mark")
    cal = effective(m.ledger(n.select("sid", "day"), "sid"), profile.filter("field = 'sleep_target_min'"), ["sid"], "sleep_target_min", "day").join(slept, ["sid", "day"], "left")
    cal = cal.withColumns({"target": target, "default": default, "mark": F.when(F.col("tst").isNotNull(), F.col("n_mark"))}).withColumn("used", _over("mark", -13, 0))
    debt = m.sleep_debt(cal, "sid", "tst", "target", "default").join(cal.filter("night").select("sid", "day", "used"), ["sid", "day"])
    owed = _metric("sleep.debt_min", F.col("debt_min"), "min", F.col("status"), "sleep.calendar_ledger", "sleep", F.col("used"), history_count=F.col("n"), longest_missing_gap=F.col("longest_missing"))
    return _long(score, rows).unionByName(_long(debt, [owed]))


def recovery(f: DataFrame) -> DataFrame:
    n = f.filter("night").withColumns({"asleep": F.when(F.col("n_complete"), F.col("n_tst")), "target": F.col("sleep_target_min"), "base_mark": F.when(F.col("n_rhr").between(25, 240) | (F.col("n_rmssd") > 0), F.col("n_mark"))})
    n = n.withColumn("used", _with(_one("n_mark"), _over("base_mark", -90, -1)))
    r = m.recovery(n, "sid", hrv="n_rmssd", rhr="n_rhr", asleep="asleep", target="target").join(n.select("sid", "day", "used"), ["sid", "day"])
    return _long(r, [_metric("recovery.score", F.col("score"), "score_0_100", F.col("status"), "recovery.anchored_logistic", "recovery", F.col("used"), z_hrv=F.col("z_hrv"), z_rhr=F.col("z_rhr"), z_sleep=F.col("z_sleep"))])


def monitoring(f: DataFrame) -> DataFrame:
    """Whether a night's signals leave their bands on the concerning side, and whether two do so together."""
    now = {"rhr": finite_between(F.col("n_rhr"), 25, 240), "spo2": finite_between(F.col("n_spo2_mean"), 0.001, 100), "respiratory": finite_between(F.col("n_respiratory"), 4, 60)}
    rows = []
    for key, v in now.items():
        for step in m.band_columns(key, "sid", m.BANDS[key], prefix=f"{key}_"):
            f = f.withColumns(step)
        # without a value of the series that day there is no band to compare with
        gone = F.col(key).isNull()
        f = f.withColumns({f"{key}_ready": F.col(f"{key}_ready") & ~gone, f"{key}_last_day": F.when(~gone, F.col(f"{key}_last_day"))})
        state = m.band_state(v, prefix=f"{key}_")
        f = f.withColumns({f"{key}_state": state, f"{key}_now": v, f"{key}_used": F.when(gone, _one("n_mark")).otherwise(_with(_one("n_mark"), _over(f"{key}_mark", -30, -1)))})
        flag = m.concern(F.col(f"{key}_state"), key)
        status = F.when(flag.isNotNull(), "REDUCED" if key in REDUCED else "VALID").when(F.col(f"{key}_state") == "NO_DATA", "INSUFFICIENT_DATA").otherwise("CALIBRATING")
        rows.append(_metric(f"anomaly.{key}", flag.cast("double"), "event_flag", status, f"anomaly.{key}_band", "monitoring", F.col(f"{key}_used"), confidence="LOW" if key in REDUCED else "MEDIUM", state=F.col(f"{key}_state"), current=F.col(f"{key}_now"), mean=F.when(F.col(f"{key}_ready"), F.col(f"{key}_mean")), lower=F.col(f"{key}_lower"), upper=F.col(f"{key}_upper")))
    f = f.filter("night")
    judged = lambda key: m.concern(F.col(f"{key}_state"), key).isNotNull()
    signals = f.select("sid", "day", "n_mark", *[F.col(f"{k}_now").alias(k) for k in now], *[F.when(judged(k), F.col(f"{k}_{c}")).alias(f"{k}_{c}") for k in now for c in ("mean", "sd")])
    w = m.watch(signals, "sid").join(f.select("sid", "day", "n_mark"), ["sid", "day"])
    both = _metric("health_signal.physiological_watch", F.col("watch").cast("double"), "event_flag", F.col("status"), "health_signal.two_signal_watch", "monitoring", _one("n_mark"), confidence="LOW", drivers=F.col("drivers"), ready_signal_count=F.col("ready_signals"))
    return _long(f, rows).unionByName(_long(w, [both]))


def change_points(f: DataFrame, start: DataFrame | None = None, since: DataFrame | None = None) -> DataFrame:
    """The CUSUM of each night's rate; the token to go on from is in the metadata. ``since`` (sid, first): only nights from the first on."""
    n = f.filter("night").withColumn("v", finite_between(F.col("n_rhr"), 25, 240))
    n = n.withColumn("v_mark", F.when(F.col("v").isNotNull(), F.col("n_mark"))).withColumn("used", _with(_one("n_mark"), _over("v_mark", -28, -1)))
    for step in m.cusum_z_columns("v", "sid"):
        n = n.withColumns(step)
    n = n if since is None else n.join(since.select("sid", "first"), "sid").filter(F.col("day") >= F.col("first"))
    c = m.cusum_fold(n.select("sid", "day", "z", F.col("v").isNull().alias("lacking"), *[F.col("used")[k].alias(k) for k in ("n_inputs", "inputs_hash", "first_input", "last_input")]), "sid", start=start)
    value = F.when(F.col("z").isNotNull(), F.col("state").isin("YELLOW", "RED").cast("double"))
    status = F.when(F.col("z").isNotNull(), "VALID").when(F.col("lacking"), "INSUFFICIENT_DATA").otherwise("CALIBRATING")
    used = F.struct("n_inputs", "inputs_hash", "first_input", "last_input")
    return _long(c, [_metric("anomaly.rhr_cusum", value, "event_flag", status, "anomaly.rhr_cusum", "monitoring", used, state=F.col("state"), cusum=F.col("cusum"), z=F.col("z"), total=F.col("total"), alarms=F.col("alarms"), calm=F.col("calm"), last=F.col("last"))])


#: The token of a change-point row, as ``change_points`` writes it.
TOKEN_SCHEMA = "total double, alarms int, calm int, last bigint"


def token(metadata: Column) -> Column:
    return F.from_json(metadata, TOKEN_SCHEMA)


def same_token(a: Column, b: Column) -> Column:
    """Whether two tokens lead on alike: sums to twelve digits."""
    return F.round(a["total"], 12).eqNullSafe(F.round(b["total"], 12)) & a["alarms"].eqNullSafe(b["alarms"]) & a["calm"].eqNullSafe(b["calm"]) & a["last"].eqNullSafe(b["last"])


def metric_table(nights: DataFrame, dailies: DataFrame, profile: DataFrame, *, cusum_start: DataFrame | None = None, cusum_since: DataFrame | None = None, apart: bool = False):
    """All metrics of the subjects, from features that are read several times: pass written ones.

    ``profile`` has sid, field, value, effective_from and effective_to (day numbers). ``cusum_start`` is the token of each
    subject's last night before its first of ``cusum_since``, from which on change points are given. With ``apart`` they
    come as a second table.
    """
    f = frame(nights, dailies, profile)
    others = reduce(DataFrame.unionByName, [direct(f), baselines(f), trends(f), regularity(f), sleep(f, profile), recovery(f), monitoring(f)])
    points = change_points(f, cusum_start, cusum_since)
    return (others, points) if apart else others.unionByName(points)
