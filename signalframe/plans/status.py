"""What can be read off the results: headlines, status, sanity checks, and a report as text."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import freshness

STATUSES = ("VALID", "REDUCED", "CALIBRATING", "INSUFFICIENT_DATA", "INVALID")


def headlines(metrics: DataFrame, names: list[str], requested: Column, as_of: Column, *, max_hours: int = 36) -> DataFrame:
    """The latest row of each subject and named metric; its number only while FRESH.

    ``metrics`` has sid, metric, date, last_end (epoch seconds), value, status. The present is the parameter ``as_of``.
    """
    last = metrics.filter(F.col("metric").isin(names)).groupBy("sid", "metric").agg(F.max(F.struct("date", "last_end", "value", "status")).alias("r")).select("sid", "metric", "r.*")
    fresh = freshness(F.col("date"), requested, F.col("last_end"), as_of, F.col("status").isin("VALID", "REDUCED"), max_hours)
    return last.withColumn("freshness", fresh).withColumn("value", F.when(F.col("freshness") == "FRESH", F.col("value")))


def counts(metrics: DataFrame) -> DataFrame:
    """Rows by metric and status."""
    return metrics.groupBy("metric", "status").agg(F.count("*").alias("n"))


def anomalies(metrics: DataFrame, pattern: str = "anomaly.%") -> DataFrame:
    """Metrics whose name matches and whose value is a flag that is set."""
    return metrics.filter(F.col("metric").like(pattern) & (F.col("value") > 0))


def insane(metrics: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Number of rows of each metric with an unknown status, or a value that is not finite or outside its limits."""
    bad = ~F.col("status").isin(*STATUSES) | F.coalesce(F.isnan("value") | (F.abs("value") == float("inf")), F.lit(False))
    for name, (low, high) in limits.items():
        bad = bad | ((F.col("metric") == name) & F.coalesce(~F.col("value").between(low, high), F.lit(False)))
    return metrics.groupBy("metric").agg(F.count_if(bad).alias("n_bad")).filter("n_bad > 0")


#: Metrics that are events, and the sleep metrics of a headline.
EVENT = "anomaly.%", "health_signal.physiological_watch"
SLEEP = {"score": "sleep.score", "need_min": "sleep.need_min", "debt_min": "sleep.debt_min"}


def overview(metrics: DataFrame, nights: DataFrame, requested: Column, as_of: Column) -> DataFrame:
    """One row for each subject with a night: how fresh its last night is, its headlines, its anomalies and signals.

    Numbers and active anomalies are shown only while the last night is FRESH; statuses and the day of the latest anomaly
    always are. ``requested`` is a day number and ``as_of`` epoch seconds: the present is a parameter.
    """
    last = nights.groupBy("sid").agg(
        F.max(F.struct("day", "t")).alias("n"), *[F.max(F.col(c).isNotNull()).alias(f"has_{k}") for k, c in (("rhr", "rhr"), ("spo2", "spo2_mean"), ("respiratory", "respiratory"))],
    ).select("sid", F.col("n.day").alias("last_night"), F.col("n.t").alias("last_end"), F.array_compact(F.array(*[F.when(F.col(f"has_{k}"), F.lit(k)) for k in ("rhr", "spo2", "respiratory")])).alias("signals_available"))
    m = metrics.select("sid", "day", "metric", "value", "status").join(last.select("sid", "last_night"), "sid")
    here, event = F.col("day") == F.col("last_night"), (F.col("metric").like(EVENT[0]) | (F.col("metric") == EVENT[1])) & (F.col("value") == 1)
    sleep = {k: F.max(F.when(here & (F.col("metric") == name), F.col("value"))).alias(k) for k, name in SLEEP.items()}
    found = m.groupBy("sid").agg(
        *sleep.values(), F.map_from_entries(F.array_sort(F.collect_set(F.when(here & F.col("metric").isin(*SLEEP.values()), F.struct("metric", "status"))))).alias("sleep_statuses"),
        F.max_by(F.struct("value", "status", "day"), F.when(F.col("metric") == "recovery.score", F.col("day"))).alias("r"), F.array_sort(F.collect_set(F.when(here & event, F.col("metric")))).alias("flagged"), F.max(F.when(event, F.col("day"))).alias("latest_anomaly_day"),
    )
    x = last.join(found, "sid", "left").withColumn("freshness", freshness(F.col("last_night"), requested, F.col("last_end"), as_of, F.lit(True)))
    shown = lambda c: F.when(F.col("freshness") == "FRESH", c)
    return x.select(
        "sid", "last_night", "freshness", *[shown(F.col(k)).alias(k) for k in SLEEP], "sleep_statuses", shown(F.col("r.value")).alias("recovery"), F.col("r.day").alias("recovery_day"), F.col("r.status").alias("recovery_status"),
        shown(F.col("flagged")).alias("active_anomalies"), "latest_anomaly_day", "signals_available",
    )


#: Limits of metric values.
SANE = {**{f"sleep.{k}_pct": (0.0, 100.1) for k in ("efficiency", "deep", "light", "rem", "awake")}, "rhr.nightly": (25.0, 240.0), **{f"spo2.nightly_{k}": (1e-9, 100.0) for k in ("mean", "min", "p10")}, "respiratory.nightly_mean": (4.0, 60.0)}


def validate(sessions: DataFrame, hr: DataFrame, spo2: DataFrame) -> DataFrame:
    """One row on the normalized tables: numbers of sessions and samples, and the first and last end of a session."""
    s = sessions.agg(F.count("*").alias("sleep_sessions"), F.count_if(F.col("is_nap_inferred") == 0).alias("main_sleep_sessions"), F.min("sleep_end_utc").alias("sleep_min_end"), F.max("sleep_end_utc").alias("sleep_max_end"))
    counts = [x.agg(F.count("*").alias(k)) for k, x in (("hr_samples", hr), ("spo2_samples", spo2))]
    return reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)), counts, s)  # one row each


def status(store, requested: Column, as_of: Column) -> dict[str, DataFrame]:
    """The read surface of a store: tables by name, all derived from what is published, none of them written."""
    m, runs = store.table("metrics"), store.runs()
    dates = [store.table(f"features_{k}").agg(F.lit(k).alias("kind"), F.count("*").alias("n"), F.max("day").alias("last_day")) for k in ("nightly", "daily")]
    return {
        "overview": overview(m, store.table("features_nightly"), requested, as_of), "metric_counts": counts(m), "features": dates[0].unionByName(dates[1]), "last_runs": runs.orderBy(F.desc("finished_at")).limit(10),
        "sanity": insane(m, SANE), "validate": validate(store.table("sleep_sessions"), store.table("heart_rate"), store.table("spo2")),
        "revisions": store.table("metric_revisions").agg(F.count("*").alias("stored_metric_revisions")),
    }


def report_rows(**tables: DataFrame) -> DataFrame:
    """(name, row): every row of the tables as JSON, to be written where they are too large for one text."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")) for name, df in tables.items()])


def report(**tables: DataFrame) -> str:
    """Small results (one row a metric or subject) as JSON: all their rows, in a fixed order; see ``report_rows`` for large ones."""
    text = lambda row: json.dumps(row, default=str, sort_keys=True)
    return text({name: sorted((r.asDict(recursive=True) for r in df.collect()), key=text) for name, df in tables.items()})
