"""The pN_ queries of the general problems over the tables of the wearable store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import known_zones, with_instant, zone_or_null
from ..operators.intervals import latest_version, periods_and_gaps
from ..operators.outliers import implausible_readings
from ..operators.regular import daily_values, empty_slots, regular_series, trailing, with_calendar
from ..operators.snapshots import snapshot_changes
from ..sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Copies added, removed or changed between consecutive scans of their source database."""
    return snapshot_changes(table(spark, d, "physical_records"), table(spark, d, "source_generations"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous sleep periods of each device and the gaps between them."""
    sessions = latest_version(table(spark, d, "sleep_sessions"), "source_record_id", "imported_at", "sid", "sleep_start_utc", "sleep_end_utc", "is_nap_inferred")
    return periods_and_gaps(sessions, "sid", "sleep_start_utc", "sleep_end_utc", F.col("is_nap_inferred") == 1)


def readings(spark: SparkSession, d: str, *columns: str, where: str = "true") -> DataFrame:
    """heart_rate with the instant of each reading in microseconds; ``where`` is a condition on its columns."""
    hr = table(spark, d, "heart_rate").filter(where).select(*dict.fromkeys(("timestamp_utc", "utc_offset_seconds", "zone_name", "local_date", *columns)))
    return with_instant(hr, "timestamp_utc", "utc_offset_seconds", "zone_name", "local_date")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Readings that are impossible, jump out of, or freeze against what the device shows around that time."""
    return implausible_readings(readings(spark, d, "source_record_id", "sid", "bpm", where="bpm is not null"), "sid", "source_record_id", "bpm", "instant_us").select("source_record_id").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Empty ten-minute slots of each device between its first and last reading."""
    return empty_slots(readings(spark, d, "sid", where="bpm is not null"), "sid", F.floor(F.col("instant_us") / 1_000_000))


def p5_series(spark: SparkSession, d: str) -> DataFrame:
    """The whole ten-minute series of each device, empty slots marked and carried."""
    hr = readings(spark, d, "sid", "bpm").withColumn("bpm", F.nanvl("bpm", F.lit(None).cast("double")))
    series = regular_series(hr, "sid", F.floor(F.col("instant_us") / 1_000_000), "bpm")
    return series.withColumns({c: F.round(c, 6) for c in ("mean_value", "carried_value")})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Readings' instants that weren't epoch seconds, and sleep offsets and dates that weren't right, in normal form."""
    hr = readings(spark, d, "source_record_id", where="not timestamp_utc rlike '^[0-9]{10}$'").filter("instant_us is not null")
    instants = hr.select(F.lit("heart_rate").alias("table_name"), F.lit("timestamp_utc").alias("field_name"), "source_record_id", F.floor(F.col("instant_us") / 1000).cast("string").alias("normal_value"))
    end = F.timestamp_seconds(F.col("sleep_end_utc"))
    zone = zone_or_null(F.col("zone_name"), known_zones(spark))
    zone_offset = F.unix_seconds(F.from_utc_timestamp(end, zone)) - F.col("sleep_end_utc")
    offset = F.when(F.col("zone_name").isNotNull(), zone_offset).otherwise(F.col("utc_offset_seconds").cast("bigint"))
    # the last microsecond before the end falls in the second before it
    date = F.date_format(F.timestamp_seconds(F.col("sleep_end_utc") - 1 + offset), "yyyy-MM-dd")
    pair = lambda field, case, value: F.when(case & value.isNotNull(), F.struct(F.lit(field).alias("field_name"), value.cast("string").alias("normal_value")))
    wrong = F.array(
        pair("utc_offset_seconds", F.col("zone_name").isNotNull() & ~F.col("utc_offset_seconds").cast("bigint").eqNullSafe(zone_offset), zone_offset),
        pair("local_date", F.col("local_date").isNotNull() & (F.col("local_date") != date), date),
    )
    sleep = table(spark, d, "sleep_sessions", "source_record_id", "sleep_start_utc", "sleep_end_utc", "local_date", "utc_offset_seconds", "zone_name").filter("sleep_end_utc > sleep_start_utc")
    fields = sleep.select("source_record_id", F.explode(F.array_compact(wrong)).alias("w")).select(F.lit("sleep_sessions").alias("table_name"), "w.field_name", "source_record_id", "w.normal_value")
    return instants.unionByName(fields).distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Steps of the last 7 and 30 days and resting heart rate of the last 30, for every calendar day of a device."""
    daily = table(spark, d, "daily_summary", "sid", "local_date", "updated_at", "steps", "resting_hr")
    days = daily_values(daily, "sid", "local_date", "updated_at", {"steps": F.when(F.col("steps") >= 0, F.col("steps")), "rhr": F.when((F.col("resting_hr") > 0) & ~F.isnan("resting_hr"), F.col("resting_hr"))})
    total = lambda column, n: F.coalesce(F.sum(column).over(trailing(n)), F.lit(0)).cast("bigint")
    return with_calendar(days, ["steps", "rhr"]).select(
        F.col("e").alias("sid"), F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")), "yyyy-MM-dd").alias("local_date"),
        total("steps", 7).alias("steps_7d"), total("steps", 30).alias("steps_30d"), total("rhr", 30).alias("rhr_30d_sum"), F.count("rhr").over(trailing(30)).alias("rhr_30d_days"),
    )


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p4_found, p5_found, p5_series, p6_found, p7_found)}
