"""Normalization and JSON profiles over the physical records."""

from __future__ import annotations

from ..operators.json_profile import json_keys
from . import normalize as n
from .common import DAYS, HR, SLEEP, DataFrame, F, SparkSession, registry, table
from .export import NIGHT_CTES, export, from_days, from_readings, from_sessions

QUERIES, SQL, query = registry()


def raw(spark: SparkSession, d: str) -> DataFrame:
    """Physical records as raw records: the envelope out of row_json, the payload value_json; only active ones."""
    p = table(spark, d, "physical_records", "physical_record_id", "last_seen_generation", "last_seen_at", "source_table", "row_json", "value_json", "status").filter("status = 'ACTIVE'")
    e = F.try_parse_json("row_json")
    get = lambda f, kind: F.try_variant_get(e, f"$.{f}", kind)
    rows = p.select(
        get("sid", "string").alias("sid"), F.concat_ws("/", "physical_record_id", "last_seen_generation", "last_seen_at").alias("source_record_id"), "source_table", get("key", "string").alias("key"), get("time", "bigint").alias("time"), get("time_zero", "bigint").alias("time_zero"),
        get("zone_offset", "bigint").alias("zone_offset"), F.col("value_json").alias("value"),
    )
    return rows.distinct()


RAW = """raw as (
  select distinct json_extract_string(row_json, '$.sid') as sid, physical_record_id || '/' || last_seen_generation || '/' || last_seen_at as source_record_id, source_table, json_extract_string(row_json, '$.key') as key, json_extract(row_json, '$.time')::bigint as time,
    json_extract(row_json, '$.time_zero')::bigint as time_zero, json_extract(row_json, '$.zone_offset')::bigint as zone_offset, case when json_valid(value_json) then value_json end as value from physical_records where status = 'ACTIVE'
), typed as (
  select *, json_extract_string(value, '$.bpm') as bpm_text, json_type(value, '$.bpm') as bpm_type, coalesce(nullif(json_extract(value, '$.time')::bigint, 0), time) as ts from raw
)"""


@query(
    """select sid, source_record_id, ts as timestamp_utc, ts + coalesce(zone_offset, 0) as local_timestamp, make_timestamp((ts + coalesce(zone_offset, 0)) * 1000000)::date as local_date, zone_offset as utc_offset_seconds, key as kind, try_cast(trim(bpm_text) as double) as bpm
    from typed where key in ('heart_rate', 'single_heart_rate') and try_cast(trim(bpm_text) as double) is not null and ts is not null""",
    RAW,
)
def nrm_heart_rate(spark: SparkSession, d: str) -> DataFrame:
    """NRM-01, CLN-11: typed heart rate samples out of raw records."""
    return n.samples(raw(spark, d), "heart_rate")


@query("select sid, source_record_id || ':spo2:sample' as source_record_id, ts as timestamp_utc, ts + off as local_timestamp, make_timestamp((ts + off) * 1000000)::date as local_date, off as utc_offset_seconds, 'sample' as kind, (85 + ts % 17)::double as value from hr", HR)
def nrm_spo2(spark: SparkSession, d: str) -> DataFrame:
    """NRM-06: saturation samples; without a time in the payload that of the record counts."""
    return n.samples(from_readings(spark, d, "spo2"), "spo2")


@query("select value_quality, count(*)::bigint as n, min(value) as lowest, max(value) as highest from (select (85 + ts % 17)::double as value, case when 85 + ts % 17 > 100 then 'INVALID' else 'VALID' end as value_quality from hr) group by 1", HR)
def cln_saturation_quality(spark: SparkSession, d: str) -> DataFrame:
    """CLN-13: quality of saturation samples; what can't be stays, marked (sentinels are tested on a fixture)."""
    x = n.samples(from_readings(spark, d, "spo2"), "spo2").withColumn("value_quality", n.saturation_quality(F.col("value")))
    return x.groupBy("value_quality").agg(F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query("select sid, source_record_id || ':stress:sample' as source_record_id, ts as timestamp_utc, (ts % 100)::double as value from hr", HR)
def nrm_stress(spark: SparkSession, d: str) -> DataFrame:
    """NRM-07, CLN-11: stress samples; a time of zero is none, numbers may be texts."""
    return n.samples(from_readings(spark, d, "stress"), "stress").select("sid", "source_record_id", "timestamp_utc", "value")


@query("select sid, source_record_id || ':steps:sample' as source_record_id, ts as timestamp_utc, (ts % 50)::bigint as steps, 1.5::double as distance, null::double as calories from hr", HR)
def nrm_steps(spark: SparkSession, d: str) -> DataFrame:
    """NRM-08, CLN-01, CLN-02: activity samples; true and false are no numbers."""
    return n.samples(from_readings(spark, d, "steps"), "steps").select("sid", "source_record_id", "timestamp_utc", "steps", "distance", "calories")


@query("select sid, count(*)::bigint as n, round(sum((ts % 9) / 2.0), 3)::double as calories, min(ts) as first_ts, max(ts) as last_ts from hr group by 1", HR)
def nrm_calories(spark: SparkSession, d: str) -> DataFrame:
    """NRM-09: calorie samples of each device."""
    x = n.samples(from_readings(spark, d, "calories"), "calories")
    return x.groupBy("sid").agg(F.count("*").alias("n"), F.round(F.sum("calories"), 3).alias("calories"), F.min("timestamp_utc").alias("first_ts"), F.max("timestamp_utc").alias("last_ts"))


@query("select sid, make_timestamp((ts + off) * 1000000)::date as local_date, count(*)::bigint as n from hr group by 1, 2", HR)
def nrm_intensity(spark: SparkSession, d: str) -> DataFrame:
    """NRM-10: intensity samples have a time only."""
    return n.samples(from_readings(spark, d, "intensity"), "intensity").groupBy("sid", "local_date").agg(F.count("*").alias("n"))


@query("select sid, sid || '/' || day || ':valid_stand:day' as source_record_id, day * 86400 + 43200 as start_timestamp_utc, day * 86400 + 43200 + 60 * coalesce(stands, 0) as end_timestamp_utc, date '1970-01-01' + day::int as local_date from days", DAYS)
def nrm_standing(spark: SparkSession, d: str) -> DataFrame:
    """NRM-11: standing intervals."""
    return n.standing_intervals(from_days(spark, d, "valid_stand")).drop("utc_offset_seconds")


@query("select sid, sid || '/' || day || ':heart_rate:high_heart_rate' as source_record_id, 'high_heart_rate' as event_type, day * 86400 + 43200 as start_timestamp_utc, day * 86400 + 43200 as end_timestamp_utc, 2 as sample_count, least(120 + day % 30, 110 + day % 40)::double as min_bpm, greatest(120 + day % 30, 110 + day % 40)::double as max_bpm from days", DAYS)
def nrm_heart_rate_events(spark: SparkSession, d: str) -> DataFrame:
    """NRM-02: events of high heart rate."""
    return n.heart_rate_events(from_days(spark, d, "heart_rate")).drop("local_date")


@query("select sid, sid || '/' || day || ':heart_rate:high_heart_rate' as source_record_id, i as sample_index, day * 86400 + 43200 + 60 * i as timestamp_utc, (case i when 0 then 120 + day % 30 else 110 + day % 40 end)::double as value from days, (values (0), (1)) v(i)", DAYS)
def nrm_heart_rate_event_samples(spark: SparkSession, d: str) -> DataFrame:
    """NRM-03: the samples of the events."""
    return n.heart_rate_event_samples(from_days(spark, d, "heart_rate"))


@query("select sid, source_record_id || ':sleep:night' as source_record_id, s as sleep_start_utc, t as sleep_end_utc, off as utc_offset_seconds, duration_minutes, sleep_score, avg_respiratory_rate, (has_stages = 1)::int as has_stages, (has_stages = 1)::int as has_rem, is_nap_inferred, '' as algorithm_version from xs", *NIGHT_CTES)
def nrm_sleep_sessions(spark: SparkSession, d: str) -> DataFrame:
    """NRM-12, CLN-23: sessions; one without stages and under four hours is a nap."""
    x = n.sleep_sessions(from_sessions(spark, d, "sleep"))
    return x.select("sid", "source_record_id", "sleep_start_utc", "sleep_end_utc", "utc_offset_seconds", "duration_minutes", "sleep_score", "avg_respiratory_rate", "has_stages", "has_rem", "is_nap_inferred", "algorithm_version")


@query("select source_record_id || ':sleep:night' as source_record_id, i as stage_index, code as raw_state, case when stage = 'unknown' then 'unknown_9' else stage end as stored, stage, case when stage = 'unknown' then 'UNKNOWN_SEMANTICS,VENDOR_DERIVED' else 'VENDOR_DERIVED' end as flags, b as start_timestamp_utc, e as end_timestamp_utc, round(mins, 6) as duration_minutes from xk", *NIGHT_CTES)
def nrm_sleep_stages(spark: SparkSession, d: str) -> DataFrame:
    """NRM-13, SRC-12, CLN-22, CLN-24: stages as stored, and as features see them."""
    x = n.sleep_stages(from_sessions(spark, d, "sleep"))
    return x.select("source_record_id", "stage_index", "raw_state", F.col("stage").alias("stored"), n.stage_name(F.col("raw_state")).alias("stage"), n.stage_flags(F.col("raw_state")).alias("flags"), "start_timestamp_utc", "end_timestamp_utc", F.round("duration_minutes", 6).alias("duration_minutes"))


@query("select sid, source_record_id || ':sport:outdoor' as source_record_id, s - 7200 as start_timestamp_utc, s - 3600 as end_timestamp_utc, 'outdoor' as workout_type, 'run' as sport_type, (100 + s % 50)::double as calories, 3600::double as duration_seconds, 120::double as avg_hr, null::double as training_load from sleep", SLEEP)
def nrm_workouts(spark: SparkSession, d: str) -> DataFrame:
    """NRM-16, SRC-17, CLN-11: workouts; no calories fall back to the total."""
    return n.workouts(from_sessions(spark, d, "sport"), "sport").select("sid", "source_record_id", "start_timestamp_utc", "end_timestamp_utc", "workout_type", "sport_type", "calories", "duration_seconds", "avg_hr", "training_load")


@query(
    """select sid, date '1970-01-01' + day::int as local_date, steps::double as steps, calories as total_calories, active as activity_duration_minutes, stands::double as standing_count, coalesce(nullif(rhr, 0), rhr + 1) as resting_hr, 60::double as avg_hr, (40 + day % 20)::double as min_hr,
      (90 + day % 9)::double as avg_spo2, (day % 100)::double as avg_stress, null::double as max_stress, (day % 100)::double as vitality, (400 + day % 60)::double as sleep_total_minutes, (28 + day % 5) / 2.0::double as avg_respiratory_rate from days""",
    DAYS,
)
def nrm_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    """NRM-04 to NRM-11, NRM-14, NRM-15, SNK-02: daily values of all source tables; of competing ones the greatest table's."""
    x = n.daily_summary(from_days(spark, d))
    return x.select("sid", "local_date", "steps", "total_calories", "activity_duration_minutes", "standing_count", "resting_hr", "avg_hr", "min_hr", "avg_spo2", "avg_stress", "max_stress", "vitality", "sleep_total_minutes", "avg_respiratory_rate")


@query(
    """select sid, make_timestamp(coalesce(time_zero, time + coalesce(zone_offset, 0)) * 1000000)::date as local_date, column_name, arg_max(v, (source_table, time, source_record_id)) as value, count(*)::bigint as n
    from (select *, coalesce(nullif(try_cast(trim(bpm_text) as double), 0), null) as v, case key when 'heart_rate' then 'resting_hr' else 'max_hr' end as column_name, 'heart_rate' as source_table from typed where json_type(value, '$.bpm') is distinct from 'BOOLEAN')
    where v is not null and time is not null group by 1, 2, 3""",
    RAW,
)
def nrm_daily_precedence(spark: SparkSession, d: str) -> DataFrame:
    """NRM-04, NRM-05: daily cells of the physical records; of competing values the one of the greatest (table, time, record) that isn't null.

    The records' keys are taken for the daily kinds, so that all of them compete.
    """
    daily = F.when(F.col("key") == "heart_rate", "resting_heart_rate").otherwise("max_heart_rate")
    rows = raw(spark, d).withColumns({"key": daily, "time": F.coalesce("time_zero", F.col("time") + F.coalesce("zone_offset", F.lit(0)))})
    best = F.max(F.struct("source_table", "time", "source_record_id", "value"))
    return n.daily_cells(rows).groupBy("sid", "local_date", "column_name").agg(best["value"].alias("value"), F.count("*").alias("n"))


@query(
    """select source_table, field_path, count(*)::bigint as n, sum(v) as total from (
      select 'steps_day' as source_table, 'steps' as field_path, steps::double as v from days where steps is not null
      union all select 'heart_rate_day', 'avg_rhr', rhr from days where rhr is not null union all select 'heart_rate_day', 'avg_hr', 70 from days union all select 'heart_rate_day', 'min_hr', 40 + day % 20 from days
      union all select 'spo2_day', 'avg_spo2', 90 + day % 9 from days union all select 'stress_day', 'avg_stress', day % 100 from days union all select 'stress_day', 'max_stress', null from days
      union all select 'calories_day', 'calories', calories from days where calories is not null union all select 'intensity_day', 'duration', active from days where active is not null
      union all select 'valid_stand_day', 'count', stands from days where stands is not null union all select 'vitality', 'latest_accumulated_vitality', day % 100 from days
      union all select 'sleep_day', 'total_duration', 400 + day % 60 from days union all select 'sleep_day', 'avg_hr', 60 from days union all select 'sleep_day', 'avg_breath', 99 from days
      union all select 'sport', 'sport_type', null from sleep union all select 'sport', 'calories', 0 from sleep union all select 'sport', 'total_cal', 100 + s % 50 from sleep union all select 'sport', 'duration', null from sleep union all select 'sport', 'avg_hrm', 120 from sleep
    ) group by 1, 2""",
    DAYS, SLEEP,
)
def nrm_derived(spark: SparkSession, d: str) -> DataFrame:
    """NRM-17: scalars of all payloads outside the high-volume tables."""
    f = n.derived_metrics(export(spark, d))
    return f.groupBy("source_table", "field_path").agg(F.count("*").alias("n"), F.sum("numeric_value").alias("total"))


@query(
    """, k as (select physical_record_id, last_seen_generation, last_seen_at, row_json::json as j, unnest(json_keys(row_json)) as field_path from physical_records)
    select field_path, count(*)::bigint as n, count(distinct json_extract_string(j, '$.' || field_path))::bigint as n_values, min(case when json_type(j, '$.' || field_path) in ('UBIGINT', 'BIGINT', 'DOUBLE') then json_extract_string(j, '$.' || field_path)::double end) as lowest,
      max(case when json_type(j, '$.' || field_path) in ('UBIGINT', 'BIGINT', 'DOUBLE') then json_extract_string(j, '$.' || field_path)::double end) as highest, max(case when json_type(j, '$.' || field_path) = 'VARCHAR' then json_extract_string(j, '$.' || field_path) end) as last_text
    from k where field_path not in ('time', 'date_time', 'start_time', 'end_time') group by 1""".replace(", k as", "with k as", 1)
)
def nrm_flatten_json(spark: SparkSession, d: str) -> DataFrame:
    """NRM-17, PRF-04: scalars of the JSON rows by path, with counts and ranges."""
    p = table(spark, d, "physical_records", "physical_record_id", "row_json")
    f = n.flatten(p, ["physical_record_id"], F.try_parse_json("row_json"))
    as_text = F.coalesce("text_value", F.col("numeric_value").cast("string"))
    return f.groupBy("field_path").agg(F.count("*").alias("n"), F.count_distinct(as_text).alias("n_values"), F.min("numeric_value").alias("lowest"), F.max("numeric_value").alias("highest"), F.max("text_value").alias("last_text"))


@query(
    """with k as (select row_json::json as j, unnest(json_keys(row_json)) as path from physical_records where json_valid(row_json))
    select path, case json_type(j, '$.' || path) when 'VARCHAR' then 'string' when 'NULL' then 'null' when 'BOOLEAN' then 'boolean' else 'number' end as kind, count(*)::bigint as n,
      min(case when json_type(j, '$.' || path) in ('UBIGINT', 'BIGINT', 'DOUBLE') then json_extract_string(j, '$.' || path)::double end) as lowest, max(case when json_type(j, '$.' || path) in ('UBIGINT', 'BIGINT', 'DOUBLE') then json_extract_string(j, '$.' || path)::double end) as highest
    from k group by 1, 2"""
)
def prf_json_keys(spark: SparkSession, d: str) -> DataFrame:
    """PRF-04: keys of the JSON rows with their kinds, counts and ranges."""
    return json_keys(table(spark, d, "physical_records", "row_json"), "row_json")
