"""An export as devices would deliver it, made of the tables of readings, sessions and days; and the same as SQL.

The store has no table of stages, saturation, stress or workouts. This module derives them by fixed arithmetic from the
readings, sessions and days that are there, writes them as raw records (envelope and JSON payload), and gives the same as
CTEs, so that everything from normalization on runs over whole tables of all kinds and can be compared.
"""

from __future__ import annotations

from .common import DAYS, HR, SLEEP, Column, DataFrame, F, SparkSession, days, samples, sessions

#: Codes of the stages of a session's six parts; a code without a name, and the seconds by which parts fall short.
PARTS, UNKNOWN_CODE, BREAK, PAUSE = (2, 3, 4, 5, 3, 2), 9, 120, 50


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _records(df: DataFrame, tables: tuple[str, ...], *rows: tuple[str, Column, Column, Column]) -> DataFrame:
    """Raw records (source table, key, time, payload) of each row of ``df`` (sid, id, off); with ``tables`` only theirs are written."""
    rows = tuple(r for r in rows if not tables or r[0] in tables)
    made = F.array(*[F.struct(F.lit(t).alias("source_table"), key.alias("key"), at.cast("bigint").alias("time"), value.alias("value"), F.concat("id", F.lit(f":{t}:"), key).alias("source_record_id")) for t, key, at, value in rows])
    return df.select("sid", "off", F.explode(made).alias("r")).select("sid", "r.source_record_id", "r.source_table", "r.key", "r.time", F.lit(None).cast("bigint").alias("time_zero"), F.col("off").cast("bigint").alias("zone_offset"), "r.value")


def from_readings(spark: SparkSession, d: str, *tables: str) -> DataFrame:
    hr = samples(spark, d).withColumnRenamed("source_record_id", "id")
    ts, key = F.col("ts"), F.lit("sample")
    return _records(
        hr, tables, ("heart_rate", F.col("kind"), ts, _json(time=ts, bpm=F.col("bpm"))), ("spo2", key, ts, _json(spo2=85 + ts % 17)), ("stress", key, ts, _json(time=F.lit(0), stress=(ts % 100).cast("string"))),
        ("steps", key, ts, _json(time=ts, steps=ts % 50, distance=F.lit("1.5"), calories=ts % 7 == 0)), ("calories", key, ts, _json(calories=ts % 9 / 2)), ("intensity", key, ts, F.lit("{}")),
    )


def from_sessions(spark: SparkSession, d: str, *tables: str) -> DataFrame:
    x = sessions(spark, d).withColumnRenamed("source_record_id", "id")
    s, t = F.col("s"), F.col("t")
    edge = lambda i: s + F.floor((t - s) * i / 6)
    short = lambda i: F.when((s % 7 == 0) & F.lit(i == 2), BREAK).when((s % 11 == 0) & F.lit(i in (1, 2, 3)), PAUSE).otherwise(0)
    code = lambda i: F.when((s % 5 == 0) & F.lit(i == 3), UNKNOWN_CODE).otherwise(PARTS[i])
    items = F.array(*[F.struct(code(i).alias("state"), edge(i).alias("start_time"), (edge(i + 1) - short(i)).alias("end_time")) for i in range(6)])
    night = _json(bedtime=s, wake_up_time=t, duration=F.col("duration_minutes"), sleep_score=F.col("sleep_score"), avg_breath=F.col("avg_respiratory_rate"), has_rem=F.col("has_stages") == 1, items=F.when(F.col("has_stages") == 1, items))
    sport = _json(start_time=s - 7200, end_time=s - 3600, sport_type=F.lit("run"), calories=F.lit(0), total_cal=100 + s % 50, duration=F.lit("3600"), avg_hrm=F.lit(120))
    return _records(x, tables, ("sleep", F.lit("night"), t, night), ("sport", F.lit("outdoor"), s - 7200, sport))


def from_days(spark: SparkSession, d: str, *tables: str) -> DataFrame:
    x = days(spark, d).select("*", F.concat_ws("/", "sid", F.col("day").cast("string")).alias("id"), F.lit(0).alias("off"))
    noon, day, key = F.col("day") * 86400 + 43200, F.col("day"), F.lit("day")
    item = lambda at, v: F.struct(at.alias("time"), v.alias("value"))
    event = _json(start_time=noon, end_time=F.lit(0), items=F.array(item(noon, 120 + day % 30), item(noon + 60, 110 + day % 40)))
    breath = lambda v: F.struct(v.cast("double").alias("avg_breath"))
    night = _json(total_duration=400 + day % 60, avg_hr=F.lit(60), avg_breath=F.lit(99), segment_details=F.array(breath(12 + day % 5), breath(F.lit(16)), breath(F.lit(None))))
    return _records(
        x, tables, ("steps_day", key, noon, _json(steps=F.col("steps"))), ("heart_rate_day", key, noon, _json(avg_rhr=F.col("rhr"), avg_hr=F.lit(70), min_hr=40 + day % 20)), ("spo2_day", key, noon, _json(avg_spo2=90 + day % 9)),
        ("stress_day", key, noon, _json(avg_stress=day % 100, max_stress=F.lit("high"))), ("calories_day", key, noon, _json(calories=F.col("calories"))), ("intensity_day", key, noon, _json(duration=F.col("active"))),
        ("valid_stand_day", key, noon, _json(count=F.col("stands"))), ("valid_stand", key, noon, _json(start_time=noon, end_time=noon + 60 * F.coalesce("stands", F.lit(0)))), ("vitality", key, noon, _json(latest_accumulated_vitality=day % 100)),
        ("sleep_day", key, noon, night), ("heart_rate", F.lit("resting_heart_rate"), noon, _json(date_time=noon, bpm=F.col("rhr") + 1)), ("heart_rate", F.lit("high_heart_rate"), noon, event),
    )


def export(spark: SparkSession, d: str) -> DataFrame:
    """All raw records."""
    return from_readings(spark, d).unionByName(from_sessions(spark, d)).unionByName(from_days(spark, d))


#: Sessions with what normalization infers, the main night of each day, and the stages of sessions.
NIGHT_CTES = (
    SLEEP,
    "xs as (select * replace ((has_stages = 0 and coalesce(duration_minutes < 240, false))::int as is_nap_inferred) from sleep)",
    "xn as (select * from xs where is_nap_inferred = 0 qualify row_number() over (partition by sid, day order by has_stages desc, coalesce(duration_minutes, 0) desc, t desc, source_record_id desc) = 1)",
    """xt as (
  select source_record_id, i, case when s % 5 = 0 and i = 3 then 9 else [2, 3, 4, 5, 3, 2][i + 1] end as code, s + floor((t - s) * i / 6)::bigint as b,
    s + floor((t - s) * (i + 1) / 6)::bigint - case when s % 7 = 0 and i = 2 then 120 when s % 11 = 0 and i in (1, 2, 3) then 50 else 0 end as e, s, t
  from xs, (select unnest(range(6)) as i) where has_stages = 1)""",
    "xk as (select *, case code when 2 then 'deep' when 3 then 'light' when 4 then 'rem' when 5 then 'awake' else 'unknown' end as stage, (e - b) / 60.0::double as mins, lag(e) over (partition by source_record_id order by b, i) as prev from xt)",
    """xg as (
  select source_record_id, bool_and(stage <> 'unknown' and b >= s and e <= t) and not bool_or(coalesce(prev > b or b - prev > 60, false)) and abs(min(b) - any_value(s)) <= 60 and abs(any_value(t) - arg_max(e, (b, i))) <= 60 as valid,
    sum(e - b) / 60.0::double as total, (any_value(t) - any_value(s)) / 60.0::double as span, sum(case when stage = 'deep' then e - b else 0 end) / 60.0::double as deep, sum(case when stage = 'light' then e - b else 0 end) / 60.0::double as light,
    sum(case when stage = 'rem' then e - b else 0 end) / 60.0::double as rem, sum(case when stage = 'awake' then e - b else 0 end) / 60.0::double as awake, min(case when stage in ('deep', 'light', 'rem') then b end) as fell,
    arg_max(e, (b, i)) filter (where stage in ('deep', 'light', 'rem')) as woke from xk group by 1)""",
    "xw as (select xk.source_record_id, list(mins order by b, e) filter (where stage = 'awake' and b >= fell and e <= woke) as awakenings, sum(e - b) filter (where stage = 'awake' and b >= fell and e <= woke) / 60.0::double as waso from xk join xg using (source_record_id) group by 1)",
)
#: Saturation and stress by reading.
READING_CTES = ("xr as (select *, (85 + ts % 17)::double as o2, (ts % 100)::double as stress, (ts + off) // 86400 as local_day from hr)",)
EXPORT_CTES = (HR, *NIGHT_CTES, DAYS, *READING_CTES)
