"""Base relations of the queries, in Spark and as SQL, and the registration of both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import sleep_date, usable_offset
from ..functions.instants import known_zones, with_instant, zone_or_null
from ..operators.intervals import latest_version
from ..operators.regular import daily_values, day_number
from ..sources.tables import table
from .problems_sql import INST

__all__ = ["F", "Column", "DataFrame", "SparkSession", "registry", "instants", "samples", "sessions", "zone_offset", "days", "nights", "table", "date_of", "HR", "SLEEP", "DAYS", "NIGHTS", "with_"]

def registry() -> tuple[dict, dict, Callable]:
    queries: dict[str, Callable] = {}
    sql: dict[str, str] = {}

    def register(text: str | None = None, *ctes: str):
        def add(f):
            queries[f.__name__] = f
            if text is not None:
                sql[f.__name__] = with_(*ctes) + text
            return f

        return add

    return queries, sql, register


def with_(*ctes: str) -> str:
    return "with " + ", ".join(ctes) + " " if ctes else ""


def date_of(day: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int"))


def zone_offset(seconds: Column, zone: Column) -> Column:
    """Offset in seconds of a known zone at an instant of the years 1 to 9999, else null."""
    at = F.when(seconds.between(-62135596800, 253402300799), seconds)
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(at), zone)) - at


def instants(spark: SparkSession, d: str) -> DataFrame:
    """(ts) of every delivered reading that has an instant."""
    hr = table(spark, d, "heart_rate", "timestamp_utc", "utc_offset_seconds", "zone_name", "local_date")
    return with_instant(hr, "timestamp_utc", "utc_offset_seconds", "zone_name", "local_date").select(F.floor(F.col("instant_us") / 1_000_000).alias("ts")).filter("ts is not null")


def samples(spark: SparkSession, d: str, within: Column | None = None) -> DataFrame:
    """Heart rate samples with an instant, in whatever spelling, the latest version of each record.

    ``within`` is a condition on ``ts`` (epoch seconds). It applies before versions are compared: a record has one
    instant in all of its deliveries.
    """
    hr = table(spark, d, "heart_rate", "source_record_id", "sid", "timestamp_utc", "bpm", "utc_offset_seconds", "zone_name", "local_date", "kind", "imported_at")
    hr = with_instant(hr, "timestamp_utc", "utc_offset_seconds", "zone_name", "local_date").withColumn("ts", F.floor(F.col("instant_us") / 1_000_000)).filter("ts is not null")
    hr = hr if within is None else hr.filter(within)
    zone = zone_or_null(F.col("zone_name"), known_zones(spark))
    hr = hr.withColumn("off", usable_offset(F.col("utc_offset_seconds"), zone_offset(F.col("ts"), zone)))
    return latest_version(hr, "source_record_id", "imported_at", "sid", "ts", "bpm", "off", "kind")


HR = INST + """, hr as (
  select source_record_id, sid, ts, bpm, off, kind from (
    select *, coalesce(case when abs(utc_offset_seconds) <= 64800 then utc_offset_seconds end, epoch(timezone(zone_name, to_timestamp(ts)))::bigint - ts, 0)::bigint as off from (
      select *, floor(us / 1000000.0)::bigint as ts from inst where us is not null))
  qualify row_number() over (partition by source_record_id order by imported_at desc, sid desc, ts desc, bpm desc nulls last, off desc, kind desc) = 1
)"""


def sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sleep sessions with bounds in order, the latest version of each record, on their sleep date.

    The offset is that of the zone at the end where the zone is known, else the given one.
    """
    zone = zone_or_null(F.col("zone_name"), known_zones(spark))
    s = table(spark, d, "sleep_sessions").withColumn("off", F.coalesce(zone_offset(F.col("sleep_end_utc"), zone), usable_offset(F.col("utc_offset_seconds"))))
    s = latest_version(s, "source_record_id", "imported_at", "sid", "sleep_start_utc", "sleep_end_utc", "off", "duration_minutes", "sleep_score", "has_stages", "is_nap_inferred", "avg_respiratory_rate")
    s = s.filter("sleep_end_utc > sleep_start_utc").withColumnsRenamed({"sleep_start_utc": "s", "sleep_end_utc": "t"})
    return s.withColumn("day", day_number(sleep_date(F.col("t"), F.col("off"))))


SLEEP = """sleep as (
  select *, datediff('day', date '1970-01-01', make_timestamp((t - 1 + off) * 1000000)::date)::bigint as day from (
    select source_record_id, sid, sleep_start_utc as s, sleep_end_utc as t, off, duration_minutes, sleep_score, has_stages, is_nap_inferred, avg_respiratory_rate from (
      select *, coalesce(epoch(timezone(zone_name, to_timestamp(case when sleep_end_utc between -62135596800 and 253402300799 then sleep_end_utc end)))::bigint - sleep_end_utc, case when abs(utc_offset_seconds) <= 64800 then utc_offset_seconds end, 0)::bigint as off from sleep_sessions)
    qualify row_number() over (partition by source_record_id order by imported_at desc, sid desc, sleep_start_utc desc nulls last, sleep_end_utc desc nulls last, off desc, duration_minutes desc nulls last, sleep_score desc nulls last, has_stages desc, is_nap_inferred desc, avg_respiratory_rate desc nulls last) = 1)
  where t > s
)"""


def nights(spark: SparkSession, d: str) -> DataFrame:
    """The main night of each device and sleep date: with stages, then longest, then latest, then greatest id; never summed."""
    from ..operators.windows import top_one

    main = sessions(spark, d).filter("is_nap_inferred = 0")
    return top_one(main, ["sid", "day"], F.desc("has_stages"), F.coalesce("duration_minutes", F.lit(0.0)).desc(), F.desc("t"), F.desc("source_record_id"))


NIGHTS = """nights as (
  select * from sleep where is_nap_inferred = 0
  qualify row_number() over (partition by sid, day order by has_stages desc, coalesce(duration_minutes, 0) desc, t desc, source_record_id desc) = 1
)"""


def days(spark: SparkSession, d: str) -> DataFrame:
    """Daily summaries: of each column of a device and day the latest value that is one (partial upsert); rhr and steps without sentinels."""
    daily = table(spark, d, "daily_summary", "sid", "local_date", "updated_at", "steps", "resting_hr", "total_calories", "activity_duration_minutes", "standing_count")
    return daily_values(
        daily, "sid", "local_date", "updated_at",
        {"steps": F.when(F.col("steps") >= 0, F.col("steps")), "rhr": F.when(F.col("resting_hr") > 0, F.col("resting_hr")), "calories": F.col("total_calories"), "active": F.col("activity_duration_minutes"), "stands": F.col("standing_count")},
    ).withColumnRenamed("e", "sid")


DAYS = """days as (
  select sid, datediff('day', date '1970-01-01', local_date::date)::bigint as day,
    arg_max(steps, (updated_at, steps)) filter (where steps >= 0) as steps,
    arg_max(resting_hr, (updated_at, resting_hr)) filter (where resting_hr > 0) as rhr,
    arg_max(total_calories, (updated_at, total_calories)) filter (where total_calories is not null) as calories,
    arg_max(activity_duration_minutes, (updated_at, activity_duration_minutes)) filter (where activity_duration_minutes is not null) as active,
    arg_max(standing_count, (updated_at, standing_count)) filter (where standing_count is not null) as stands
  from daily_summary group by 1, 2
)"""
