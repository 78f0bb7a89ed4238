"""Nightly and daily features of a subject.

Every feature row has a fingerprint of all that went into it (an order-independent hash of the rows of each kind, profile
revision, versions; no wall clock) and the number of its source rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import clock_minute, sleep_date
from ..functions.identity import fingerprint
from ..operators.joins import interval_join
from ..operators.regular import day_number
from ..operators.statistics import percentile
from ..operators.windows import top_one

ASLEEP = ("deep", "light", "rem")
STAGES = (*ASLEEP, "awake")
#: What the features are computed by: a change of it changes every fingerprint.
FEATURE_VERSION = "features-2"


def marks(*columns: str) -> Column:
    """Exclusive or of the hashes of a group's rows: in no order, and without being collected."""
    return F.bit_xor(F.xxhash64(*columns))


def main_night(sessions: DataFrame) -> DataFrame:
    """The main session of each sleep date: with stages, then longest, then latest, then greatest id; overlapping ones are never summed."""
    s = sessions.filter("is_nap_inferred = 0 and t > s").withColumn("day", day_number(sleep_date(F.col("t"), F.col("off"))))
    return top_one(s, ["sid", "day"], F.desc("has_stages"), F.coalesce("duration_minutes", F.lit(0.0)).desc(), F.desc("t"), F.desc("source_record_id"))


def stage_summary(nights: DataFrame, stages: DataFrame) -> DataFrame:
    """Per night with stages: whether they are a complete account of it, minutes of each stage, and awakenings.

    Complete: all four-type stages inside the session, none overlapping, edges and inner gaps within a minute, and the
    sum within a minute of the session. Awakenings lie wholly between the first and the last time asleep.
    """
    w = Window.partitionBy("source_record_id").orderBy("start", "stage_index")
    x = nights.select("source_record_id", "s", "t", "has_stages").join(stages, "source_record_id").withColumn("before", F.lag("end").over(w))
    seconds = F.col("end") - F.col("start")
    asleep = F.col("stage").isin(*ASLEEP)
    g = x.groupBy("source_record_id").agg(
        F.bool_and(F.col("stage").isin(*STAGES) & (F.col("start") >= F.col("s")) & (F.col("end") <= F.col("t")) & (F.col("has_stages") == 1)).alias("inside"),
        F.bool_or(F.coalesce((F.col("before") > F.col("start")) | (F.col("start") - F.col("before") > 60), F.lit(False))).alias("broken"),
        F.min("start").alias("first"), F.max_by("end", F.struct("start", "stage_index")).alias("last"), F.max("s").alias("s"), F.max("t").alias("t"),
        *[(F.sum(F.when(F.col("stage") == k, seconds).otherwise(0)) / 60.0).alias(k) for k in STAGES],
        F.min(F.when(asleep, F.col("start"))).alias("fell"), F.max_by(F.when(asleep, F.col("end")), F.when(asleep, F.struct("start", "stage_index"))).alias("woke"),
        F.array_sort(F.collect_list(F.when(F.col("stage") == "awake", F.struct("start", "end")))).alias("awakes"), F.count("*").alias("n_stages"), marks("stage_index", "stage", "start", "end").alias("stage_marks"),
    )
    total = sum((F.col(k) for k in STAGES), F.lit(0.0))
    edges = (F.abs(F.col("first") - F.col("s")) <= 60) & (F.abs(F.col("t") - F.col("last")) <= 60)
    span = (F.col("t") - F.col("s")) / 60.0
    valid = F.col("inside") & ~F.col("broken") & edges
    g = g.withColumns({"sensor_gap": valid & (F.abs(span - total) > 1), "complete": valid & (F.abs(span - total) <= 1)})
    inner = F.filter("awakes", lambda a: (a["start"] >= F.col("fell")) & (a["end"] <= F.col("woke")))
    only = lambda c: F.when(F.col("complete"), c)
    g = g.withColumn("awakenings", F.when(F.col("complete") & F.col("fell").isNotNull(), F.transform(inner, lambda a: (a["end"] - a["start"]) / 60.0)))
    return g.select("source_record_id", "complete", "sensor_gap", *[only(F.col(k)).alias(k) for k in STAGES], "awakenings", F.when(F.col("awakenings").isNotNull(), F.aggregate(inner, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"]) / 60.0).alias("waso"), "n_stages", "stage_marks")


def nocturnal_rate(nights: DataFrame, hr: DataFrame, *, width: int = 30, least: int = 27) -> DataFrame:
    """Lowest mean of ``width`` forward minutes with ``least`` of them measured, and the number of measured minutes.

    All readings of the night are its sources; only plausible ones are measurements.
    """
    inside = interval_join(hr.select("sid", "ts", "bpm"), nights.select("sid", "source_record_id", "s", "t"), ["sid"], "ts", "s", "t")
    valid = F.when(F.col("bpm").between(25, 240), F.col("bpm"))
    minute = inside.groupBy("source_record_id", F.floor(F.col("ts") / 60).alias("minute")).agg(F.avg(valid).alias("v"), F.count("*").alias("n"), marks("ts", "bpm").alias("marks"))
    w = Window.partitionBy("source_record_id").orderBy("minute").rangeBetween(0, width - 1)
    m = minute.withColumn("a", F.when(F.col("v").isNotNull() & (F.count("v").over(w) >= least), F.avg("v").over(w)))
    return m.groupBy("source_record_id").agg(F.min("a").alias("night_rhr"), F.count("v").alias("hr_minutes"), F.sum("n").alias("n_hr"), F.bit_xor("marks").alias("hr_marks"))


def saturation(nights: DataFrame, spo2: DataFrame) -> DataFrame:
    """Mean, minimum and tenth percentile of valid saturations, each only with enough of them over four hours."""
    inside = interval_join(spo2.filter("value > 0 and value <= 100").select("sid", "ts", "value"), nights.select("sid", "source_record_id", "s", "t"), ["sid"], "ts", "s", "t")
    n, span = F.count("*"), (F.max("ts") - F.min("ts")) / 60.0
    gate = lambda least, v: F.when((n >= least) & (span >= 240), v)
    return inside.groupBy("source_record_id").agg(n.alias("spo2_samples"), span.alias("spo2_span_min"), gate(6, F.avg("value")).alias("spo2_mean"), gate(12, F.min("value")).alias("spo2_min"), gate(12, percentile("value", 0.1)).alias("spo2_p10"), marks("ts", "value").alias("spo2_marks"))


def nightly(sessions: DataFrame, stages: DataFrame, hr: DataFrame, rhr: DataFrame, spo2: DataFrame, hrv: DataFrame | None = None, *, profile_revision: str = "", rate_minutes: int = 30, rate_least: int = 27) -> DataFrame:
    """One row for each subject and sleep date with a main session; what isn't known is null, never zero.

    ``hrv``: measured RMSSD in milliseconds of a session (sid, source_record_id, value), where a source has it; a value of
    zero or less is an error of that source and refused.
    """
    n = main_night(sessions)
    if hrv is None:
        n = n.withColumn("rmssd", F.lit(None).cast("double"))
    else:
        checked = F.when(F.col("value") > 0, F.col("value")).when(F.col("value").isNotNull(), F.raise_error(F.lit("variability must be a positive RMSSD in ms")).cast("double"))
        n = n.join(hrv.select("sid", "source_record_id", checked.alias("rmssd")), ["sid", "source_record_id"], "left")
    rate = nocturnal_rate(n, hr, width=rate_minutes, least=rate_least)
    out = n.join(stage_summary(n, stages), "source_record_id", "left").join(rate, "source_record_id", "left").join(saturation(n, spo2), "source_record_id", "left").join(rhr.select("sid", "day", "rhr"), ["sid", "day"], "left")
    tst, tib = F.col("deep") + F.col("light") + F.col("rem"), (F.col("t") - F.col("s")) / 60.0
    complete = F.coalesce("complete", F.lit(False))
    flags = F.array_sort(F.array_compact(F.array(F.lit("VENDOR_DERIVED"), F.when(~complete & ~F.coalesce("sensor_gap", F.lit(False)), "STAGE_INCOMPLETE"), F.when(F.col("sensor_gap"), "SENSOR_GAP"), F.when(F.col("spo2_mean").isNull(), "LOW_COVERAGE"))))
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("hr_minutes", "spo2_samples", "n_stages", "n_hr")}
    out = out.withColumns({"tib": tib, "tst": tst, "efficiency": F.when(tst <= tib + 1, F.try_divide(tst * 100, tib)), "bedtime": clock_minute(F.col("s"), F.col("off")).cast("double"), "wake": clock_minute(F.col("t"), F.col("off")).cast("double"), "complete": complete, "flags": F.concat_ws(",", flags), **counts})
    out = out.withColumn("respiratory", F.when(F.col("respiratory") > 0, F.col("respiratory")))
    inputs = F.to_json(F.struct("source_record_id", "s", "t", "off", "duration_minutes", "has_stages", "n_stages", "stage_marks", "n_hr", "hr_marks", "spo2_samples", "spo2_marks", "rhr", "respiratory", "rmssd"))
    names = ("sid", "day", "source_record_id", "s", "t", "tib", "tst", *STAGES, "waso", "awakenings", "efficiency", "complete", "bedtime", "wake", "night_rhr", "hr_minutes", "rhr", "spo2_mean", "spo2_min", "spo2_p10", "spo2_samples", "respiratory", "rmssd", "flags")
    return out.select(
        *names, F.log("rmssd").alias("ln_rmssd"), F.coalesce("spo2_span_min", F.lit(0.0)).alias("spo2_span_min"), (1 + F.col("n_stages") + F.col("n_hr") + F.col("spo2_samples")).alias("n_sources"),
        fingerprint(inputs, F.lit(profile_revision), "nightly", FEATURE_VERSION).alias("fingerprint"),
    )


def daily(days: DataFrame, hr: DataFrame, stress: DataFrame, spo2: DataFrame, *, profile_revision: str = "") -> DataFrame:
    """One row for each daily summary: measured minutes and largest gap of heart rate, saturation minutes, distribution of stress, activity as given.

    ``hr``, ``stress`` and ``spo2`` have sid, day, ts and bpm or value; implausible heart rates and saturations are no
    measurements. Days without a summary have no row; distance has no known unit.
    """
    minute = hr.groupBy("sid", "day", F.floor(F.col("ts") / 60).alias("minute")).agg(F.count_if(F.col("bpm").between(25, 240)).alias("valid"), F.count("*").alias("n"), marks("ts", "bpm").alias("marks"))
    measured = F.when(F.col("valid") > 0, F.col("minute"))
    earlier = F.last(measured, ignorenulls=True).over(Window.partitionBy("sid", "day").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1))
    h = minute.withColumn("gap", measured - earlier).groupBy("sid", "day").agg(F.count_if(F.col("valid") > 0).alias("hr_minutes"), F.max("gap").alias("hr_max_gap_min"), F.sum("n").alias("n_hr"), F.bit_xor("marks").alias("hr_marks"))
    s = stress.filter("value is not null").groupBy("sid", "day").agg(F.count("*").alias("stress_samples"), F.median("value").alias("stress_median"), percentile("value", 0.1).alias("stress_p10"), percentile("value", 0.9).alias("stress_p90"), marks("ts", "value").alias("stress_marks"))
    o = spo2.filter("value > 0 and value <= 100").groupBy("sid", "day").agg(F.count("*").alias("spo2_samples"), F.count_distinct(F.floor(F.col("ts") / 60)).alias("spo2_minutes"), marks("ts", "value").alias("spo2_marks"))
    out = days.join(h, ["sid", "day"], "left").join(s, ["sid", "day"], "left").join(o, ["sid", "day"], "left")
    out = out.withColumn("distance", F.lit(None).cast("double")).fillna(0, ["hr_minutes", "stress_samples", "spo2_samples", "spo2_minutes", "n_hr"])
    hashed = ("n_hr", "hr_marks", "stress_samples", "stress_marks", "spo2_samples", "spo2_marks")
    inputs = F.to_json(F.struct(*[c for c in days.columns], *hashed))
    return out.withColumns({"n_sources": 1 + F.col("n_hr") + F.col("stress_samples") + F.col("spo2_samples"), "fingerprint": fingerprint(inputs, F.lit(profile_revision), "daily", FEATURE_VERSION)}).drop("n_hr", *[c for c in hashed if c.endswith("_marks")])
