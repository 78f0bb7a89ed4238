"""Features and the metric table, from an export through normalization; their SQL starts from the base tables."""

from __future__ import annotations

from ..operators.regular import day_number
from ..session import materialize
from . import features as f
from . import metric_table as t
from . import normalize as n
from .common import DataFrame, F, SparkSession, registry
from .export import EXPORT_CTES, export, from_days, from_readings, from_sessions
from .status import overview

QUERIES, SQL, query = registry()
#: Readings here come every five minutes: the lowest mean is that of two hours, with at least twelve minutes measured.
RATE = {"rate_minutes": 120, "rate_least": 12}

NF = """o2 as (
  select xn.source_record_id, count(*) as spo2_samples, (max(ts) - min(ts)) / 60.0::double as spo2_span, avg(o2) as spo2_avg, min(o2) as spo2_low, quantile_cont(o2, 0.1) as spo2_q10
  from xn join xr on xr.sid = xn.sid and ts >= s and ts < t where o2 <= 100 group by 1
), minute_rate as (
  select xn.source_record_id, ts // 60 as minute, avg(bpm) filter (where bpm between 25 and 240) as v, count(bpm) as n from xn join xr on xr.sid = xn.sid and ts >= s and ts < t where bpm is not null group by 1, 2
), window_rate as (
  select *, case when v is not null and count(v) over w >= 12 then avg(v) over w end as a from minute_rate window w as (partition by source_record_id order by minute range between current row and 119 following)
), night_rate as (select source_record_id, min(a) as night_rhr, count(v) as hr_minutes, sum(n) as n_hr from window_rate group by 1
), nf0 as (
  select xn.*, coalesce(xg.valid and abs(xg.span - xg.total) <= 1, false) as ok, coalesce(xg.valid and abs(xg.span - xg.total) > 1, false) as sensor_gap, xg.deep as dp, xg.light as lt, xg.rem as rm, xg.awake as aw, xg.fell, xw.awakenings as awk, xw.waso as waso_min,
    (xn.t - xn.s) / 60.0::double as tib, coalesce(o2.spo2_samples, 0) as spo2_samples, coalesce(spo2_span, 0) as spo2_span, case when o2.spo2_samples >= 6 and spo2_span >= 240 then spo2_avg end as spo2_mean,
    case when o2.spo2_samples >= 12 and spo2_span >= 240 then spo2_low end as spo2_min, case when o2.spo2_samples >= 12 and spo2_span >= 240 then spo2_q10 end as spo2_p10, night_rhr, coalesce(hr_minutes, 0) as hr_minutes, coalesce(n_hr, 0) as n_hr,
    d.rhr as rhr_given, case when avg_respiratory_rate > 0 then avg_respiratory_rate end as respiratory
  from xn left join xg on xg.source_record_id = xn.source_record_id left join xw on xw.source_record_id = xn.source_record_id left join o2 on o2.source_record_id = xn.source_record_id
    left join night_rate on night_rate.source_record_id = xn.source_record_id left join days d on d.sid = xn.sid and d.day = xn.day
), nf as (
  select *, case when ok then dp end as deep, case when ok then lt end as light, case when ok then rm end as rem, case when ok then aw end as awake, case when ok then dp + lt + rm end as tst,
    case when ok and fell is not null then coalesce(awk, []) end as awakenings, case when ok and fell is not null then coalesce(waso_min, 0) end as waso, coalesce(nullif(rhr_given, 0), rhr_given + 1) as rhr,
    ((((s + off) // 60) % 1440 + 1440) % 1440)::double as bedtime, ((((t + off) // 60) % 1440 + 1440) % 1440)::double as wake from nf0
)"""
DF = """hr_minute as (
  select sid, local_day as day, ts // 60 as minute, count(*) filter (where bpm between 25 and 240) as valid, count(bpm) as n from xr where bpm is not null group by 1, 2, 3
), hr_gap as (
  select *, case when valid > 0 then minute - max(case when valid > 0 then minute end) over (partition by sid, day order by minute rows between unbounded preceding and 1 preceding) end as gap from hr_minute
), hr_day as (select sid, day, count(*) filter (where valid > 0) as hr_minutes, max(gap) as hr_max_gap_min, sum(n) as n_hr from hr_gap group by 1, 2
), reading_day as (
  select sid, local_day as day, count(*) as stress_samples, median(stress) as stress_median, quantile_cont(stress, 0.1) as stress_p10, quantile_cont(stress, 0.9) as stress_p90,
    count(*) filter (where o2 <= 100) as spo2_samples, count(distinct case when o2 <= 100 then ts // 60 end) as spo2_minutes from xr group by 1, 2
), df as (
  select d.sid, d.day, d.steps, d.calories, d.active, d.stands, coalesce(nullif(d.rhr, 0), d.rhr + 1) as rhr, coalesce(hr_minutes, 0) as hr_minutes, hr_max_gap_min, coalesce(spo2_samples, 0) as spo2_samples, coalesce(spo2_minutes, 0) as spo2_minutes,
    coalesce(stress_samples, 0) as stress_samples, stress_median, stress_p10, stress_p90, 1 + coalesce(n_hr, 0) + coalesce(spo2_samples, 0) + coalesce(stress_samples, 0) as n_sources
  from days d left join hr_day h on h.sid = d.sid and h.day = d.day left join reading_day r on r.sid = d.sid and r.day = d.day
)"""
FEATURES = (*EXPORT_CTES, NF, DF)
PROF = """prof as (
  select sid, 420 + 15 * (ascii(right(sid, 1)) % 5)::double as value, 20089 as f, 20178 as u from (select distinct sid from sleep)
  union all select sid, 470, 20179, null from (select distinct sid from sleep) where ascii(right(sid, 1)) % 2 = 0
)"""
SER = """ser as (
  select sid, day, 'rhr' as key, rhr::double as v from df where rhr between 25 and 240 union all select sid, day, 'sleep_tst', tst from nf where tst >= 0 union all select sid, day, 'spo2', spo2_mean from nf where spo2_mean > 0 and spo2_mean <= 100
  union all select sid, day, 'respiratory', respiratory from nf where respiratory between 4 and 60 union all select sid, day, 'steps', steps::double from df where steps >= 0 union all select sid, day, 'stress_vendor', stress_median from df where stress_median is not null
)"""
BD = """bd0 as (
  select *, count(*) over w as n, avg(v) over w as mean, stddev_pop(v) over w as sd, max(day) over w as last_day, list(v) over w as prior, greatest(case key when 'rhr' then 3.0 when 'spo2' then 1.5 when 'respiratory' then 0.8 end::double, 1.65::double * stddev_pop(v) over w) as half
  from ser where key in ('rhr', 'sleep_tst', 'spo2', 'respiratory') window w as (partition by sid, key order by day range between 30 preceding and 1 preceding)
), bd as (
  select *, coalesce(n >= 5 and day - last_day <= 14, false) as ready, case when key = 'spo2' then greatest(90, mean - half) else mean - half end as lower, case when key <> 'spo2' then mean + half end as upper from bd0
)"""
SHOWN = ("sid", "day", "metric", "status", "n_inputs", "confidence")


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(*SHOWN, (F.round("value", 6) + 0.0).alias("value"))


def _dated(x: DataFrame) -> DataFrame:
    return x.withColumns({"ts": F.col("timestamp_utc"), "day": day_number(F.col("local_date"))})


def night_features(spark: SparkSession, d: str, **options) -> DataFrame:
    readings = lambda kind: _dated(n.samples(from_readings(spark, d, kind), kind))
    days = n.daily_summary(from_days(spark, d, "heart_rate_day", "heart_rate"))
    s = n.sleep_sessions(from_sessions(spark, d, "sleep")).withColumnsRenamed({"sleep_start_utc": "s", "sleep_end_utc": "t", "utc_offset_seconds": "off", "avg_respiratory_rate": "respiratory"})
    stages = n.sleep_stages(from_sessions(spark, d, "sleep")).select("source_record_id", "stage_index", n.stage_name(F.col("raw_state")).alias("stage"), F.col("start_timestamp_utc").alias("start"), F.col("end_timestamp_utc").alias("end"))
    rhr = days.select("sid", day_number(F.col("local_date")).alias("day"), F.when(F.col("resting_hr") > 0, F.col("resting_hr")).alias("rhr"))
    return f.nightly(s, stages, readings("heart_rate"), rhr, readings("spo2"), **options)


def day_features(spark: SparkSession, d: str, **options) -> DataFrame:
    x = n.daily_summary(from_days(spark, d))
    days = x.select("sid", day_number(F.col("local_date")).alias("day"), F.col("steps").cast("bigint").alias("steps"), F.col("total_calories").alias("calories"), F.col("activity_duration_minutes").alias("active"), F.col("standing_count").cast("int").alias("stands"), F.when(F.col("resting_hr") > 0, F.col("resting_hr")).alias("rhr"))
    return f.daily(days, *[_dated(n.samples(from_readings(spark, d, kind), kind)) for kind in ("heart_rate", "stress", "spo2")], **options)


def profiles(spark: SparkSession, d: str) -> DataFrame:
    """A dated sleep target of each device: two periods for some, one for others."""
    from .common import sessions

    last = F.ascii(F.substring("sid", -1, 1))
    entry = lambda value, first, end: F.struct(value.cast("double").alias("value"), F.lit(first).alias("effective_from"), F.lit(end).cast("int").alias("effective_to"))
    entries = F.array_compact(F.array(entry(420 + 15 * (last % 5), 20089, 20178), F.when(last % 2 == 0, entry(F.lit(470), 20179, None))))
    return sessions(spark, d).select("sid").distinct().select("sid", F.lit("sleep_target_min").alias("field"), F.explode(entries).alias("e")).select("sid", "field", "e.*")


def frame(spark: SparkSession, d: str) -> DataFrame:
    return t.frame(materialize(night_features(spark, d, **RATE)), materialize(day_features(spark, d)), profiles(spark, d))


@query(
    """select sid, day, source_record_id || ':sleep:night' as source_record_id, s, t, round(tib, 6) as tib, round(tst, 6) as tst, round(deep, 6) as deep, round(light, 6) as light, round(rem, 6) as rem, round(awake, 6) as awake, round(waso, 6) as waso, len(awakenings) as n_awakenings,
      case when tst <= tib + 1 then round(100 * tst / tib, 6) end as efficiency, ok as complete, bedtime, wake, round(night_rhr, 6) as night_rhr, hr_minutes, rhr, round(spo2_mean, 6) as spo2_mean, spo2_min, round(spo2_p10, 6) as spo2_p10, spo2_samples, round(spo2_span, 6) as spo2_span_min, respiratory,
      array_to_string(list_filter([case when spo2_mean is null then 'LOW_COVERAGE' end, case when sensor_gap then 'SENSOR_GAP' end, case when not ok and not sensor_gap then 'STAGE_INCOMPLETE' end, 'VENDOR_DERIVED'], lambda x: x is not null), ',') as flags,
      1 + case when has_stages = 1 then 6 else 0 end + n_hr + spo2_samples as n_sources from nf""",
    *FEATURES,
)
def feat_night(spark: SparkSession, d: str) -> DataFrame:
    """FEAT-NIGHT, AGG-01, AGG-02, AGG-05, AGG-13, JN-01, JN-05, JN-06: features of each main night, from raw records on."""
    x = night_features(spark, d, **RATE)
    r = lambda c: (F.round(c, 6) + 0.0).alias(c)
    return x.select(
        "sid", "day", "source_record_id", "s", "t", *[r(c) for c in ("tib", "tst", *f.STAGES, "waso", "efficiency", "night_rhr", "spo2_mean", "spo2_p10", "spo2_span_min")], F.size("awakenings").cast("bigint").alias("n_awakenings"),
        "complete", "bedtime", "wake", "hr_minutes", "rhr", "spo2_min", "spo2_samples", "respiratory", "flags", "n_sources",
    )


@query("select sid, day, steps, calories, active, stands, rhr, null::double as distance, hr_minutes, hr_max_gap_min, spo2_samples, spo2_minutes, stress_samples, stress_median, round(stress_p10, 6) as stress_p10, round(stress_p90, 6) as stress_p90, n_sources from df", *FEATURES)
def feat_day(spark: SparkSession, d: str) -> DataFrame:
    """FEAT-DAY, AGG-03, AGG-04, AGG-06, AGG-07: features of each daily summary."""
    return day_features(spark, d).withColumns({c: F.round(c, 6) for c in ("stress_p10", "stress_p90")}).drop("fingerprint")


M_DIRECT = """md as (
  select *, case when tib between 0 and 1440 then tib end as v_tib, case when tst between 0 and 1440 then tst end as w_tst from nf
), me as (
  select *, ok and greatest(deep, light, rem, awake) <= 1440 and coalesce(w_tst <= v_tib + 1 and abs(w_tst + awake - v_tib) <= 1, true) as sound from md
), mg as (
  select *, case when sound then w_tst end as v_tst, case when sound then deep end as v_deep, case when sound then light end as v_light, case when sound then rem end as v_rem, case when sound then awake end as v_awake from me
), m_direct as (
  select sid, day, x.k as metric, x.v as value, case when x.v is null then 'INSUFFICIENT_DATA' else x.f end as status, 1 as n_inputs, x.c as confidence from (
    select sid, day, unnest([
      {k: 'rhr.nightly', v: case when night_rhr between 25 and 240 then night_rhr end, f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.time_in_bed_min', v: v_tib, f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.total_sleep_time_min', v: v_tst, f: 'VALID', c: 'MEDIUM'},
      {k: 'sleep.deep_min', v: v_deep, f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.light_min', v: v_light, f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.rem_min', v: v_rem, f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.awake_min', v: v_awake, f: 'VALID', c: 'MEDIUM'},
      {k: 'sleep.efficiency_pct', v: case when 100 * v_tst / nullif(v_tib, 0) <= 100.1 then 100 * v_tst / nullif(v_tib, 0) end, f: 'VALID', c: 'MEDIUM'},
      {k: 'sleep.deep_pct', v: 100 * v_deep / nullif(v_tst, 0), f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.light_pct', v: 100 * v_light / nullif(v_tst, 0), f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.rem_pct', v: 100 * v_rem / nullif(v_tst, 0), f: 'VALID', c: 'MEDIUM'}, {k: 'sleep.awake_pct', v: 100 * v_awake / nullif(v_tib, 0), f: 'VALID', c: 'MEDIUM'},
      {k: 'spo2.nightly_count', v: spo2_samples::double, f: 'VALID', c: 'HIGH'}, {k: 'spo2.nightly_span_min', v: spo2_span, f: 'VALID', c: 'MEDIUM'}, {k: 'spo2.nightly_mean', v: spo2_mean, f: 'VALID', c: 'MEDIUM'}, {k: 'spo2.nightly_min', v: spo2_min, f: 'VALID', c: 'LOW'}, {k: 'spo2.nightly_p10', v: spo2_p10, f: 'VALID', c: 'LOW'},
      {k: 'respiratory.nightly_mean', v: case when respiratory between 4 and 60 then respiratory end, f: 'REDUCED', c: 'LOW'}]) as x from mg)
  union all
  select coalesce(df.sid, nf.sid), coalesce(df.day, nf.day), 'rhr.vendor_daily', coalesce(case when df.rhr between 25 and 240 then df.rhr end, case when nf.rhr between 25 and 240 then nf.rhr end) as r, 'VALID', 1, 'MEDIUM' from df full join nf on nf.sid = df.sid and nf.day = df.day where r is not null
)"""
M_BASE = """m_base as (
  select sid, day, 'baseline.' || key || '.band_mean' as metric, case when ready then mean end as value, case when ready then (case key when 'respiratory' then 'REDUCED' else 'VALID' end) else 'CALIBRATING' end as status, n + 1 as n_inputs, case when ready then 'MEDIUM' else 'LOW' end as confidence from bd where key <> 'sleep_tst'
  union all select sid, day, key || '.deviation', case when ready then v - mean end, case when ready then (case key when 'respiratory' then 'REDUCED' else 'VALID' end) else 'CALIBRATING' end, n + 1, 'MEDIUM' from bd where key <> 'sleep_tst'
  union all select sid, day, 'baseline.' || key || '.ewma', case when ready then list_reduce(prior, lambda a, x: a + (x - a) * (2.0::double / 31)) end, case when ready then (case key when 'respiratory' then 'REDUCED' else 'VALID' end) else 'CALIBRATING' end, n + 1, 'MEDIUM' from bd
)"""
M_TRENDS = """tw as (select unnest([14, 30, 90]) as wd, unnest([7, 14, 30]) as least
), tg as (select a.sid, a.key, a.day, wd, least, count(*) as n, list(b.day order by b.day) as ds from ser a, tw join ser b on b.sid = a.sid and b.key = a.key and b.day between a.day - wd + 1 and a.day group by all
), th as (select *, coalesce(list_max(list_transform(range(1, len(ds)), lambda i: ds[i + 1] - ds[i])), 0) as mg from tg
), tq as (
  select th.sid, th.key, th.day, wd, median((c.v - b.v) / (c.day - b.day)) * 7 as slope from th join ser b on b.sid = th.sid and b.key = th.key and b.day between th.day - wd + 1 and th.day join ser c on c.sid = th.sid and c.key = th.key and c.day > b.day and c.day <= th.day
  where n >= least and n >= 0.6 * wd and mg <= 7 group by all
), m_trends as (
  select th.sid, th.day, 'trend.' || th.key || '.' || th.wd || 'd.theilsen' as metric, slope as value, case when slope is null then 'CALIBRATING' when th.key in ('respiratory', 'stress_vendor') then 'REDUCED' else 'VALID' end as status, n as n_inputs, case when slope is null then 'LOW' else 'MEDIUM' end as confidence
  from th left join tq on tq.sid = th.sid and tq.key = th.key and tq.day = th.day and tq.wd = th.wd
)"""
M_REGULARITY = """rw as (
  select sid, day, count(*) over w as n, list(bedtime) over w as beds, list(wake) over w as wakes, atan2(sum(sin(bedtime * pi() / 720)) over w, sum(cos(bedtime * pi() / 720)) over w) * 720 / pi() as mb, atan2(sum(sin(wake * pi() / 720)) over w, sum(cos(wake * pi() / 720)) over w) * 720 / pi() as mw
  from nf where ok window w as (partition by sid order by day range between 13 preceding and current row)
), rr as (
  select *, (list_aggregate(list_transform(beds, lambda x: ((x - mb + 720) - 1440 * floor((x - mb + 720) / 1440)) - 720), 'stddev_pop') + list_aggregate(list_transform(wakes, lambda x: ((x - mw + 720) - 1440 * floor((x - mw + 720) / 1440)) - 720), 'stddev_pop')) / 2 as sigma from rw
), m_regularity as (
  select sid, day, 'sleep.regularity' as metric, case when n >= 5 then round_even(100 * (1 - least(greatest(sigma - 20, 0), 100) / 100), 0) end as value, case when n >= 5 then 'VALID' else 'CALIBRATING' end as status, n as n_inputs, case when n >= 5 then 'MEDIUM' else 'LOW' end as confidence from rr
)"""
M_SLEEP = """sp as (
  select *, list(case when bedtime / 60 < 12 then bedtime / 60 + 12 else bedtime / 60 - 12 end) over (partition by sid order by day range between 14 preceding and 1 preceding) as prior, tst / 60 as h, case when bedtime / 60 < 12 then bedtime / 60 + 12 else bedtime / 60 - 12 end as bn from nf
), sd_ as (select *, (bn - list_median(prior)) * 60 as diff, coalesce(len(prior), 0) as history from sp
), sc as (
  select *, case when h between 7 and 9 then 100 when h < 7 then greatest(0, least(100, trunc(100 * (1 + exp(-1.5::double * 2)) / (1 + exp(least(709, -1.5::double * (h - 5))))))) else greatest(50, least(100, trunc(100 * (1 + exp(0.8::double * -2)) / (1 + exp(least(709, 0.8::double * (h - 11))))))) end as p_duration,
    trunc((least(100, trunc(deep / 90 * 100)) + least(100, trunc(rem / 90 * 100))) * 0.5::double) as p_stages, greatest(0, trunc(100 - (case when diff > 15 then (diff - 15) / 105 * 100 when diff < -15 then least(20, (-diff - 15) / 105 * 100) else 0 end))) as p_consistency,
    greatest(0, least(100, trunc((case when waso <= 20 then 80 else greatest(0, 80 - (waso - 20) / 70 * 80) end) + [20, 20, 15, 10, 0][least(len(list_filter(awakenings, lambda a: a > 5)), 4) + 1]))) as p_interruptions,
    case when not ok or tst is null or waso is null then 'INSUFFICIENT_DATA' when history < 5 then 'CALIBRATING' when tst > 0 and tst <= 1440 and deep + rem <= tst + 1 then 'VALID' else 'INVALID' end as state from sd_
), lg as (
  select nf.sid, nf.day, nf.day - 13 + k as d from nf, (select unnest(range(14)) as k)
), lt as (
  select lg.sid, lg.day, lg.d, coalesce(p.value, 480) as target, p.value is null as dflt, case when x.ok and x.tst between 0.001 and 1440 then x.tst end as slept from lg left join prof p on p.sid = lg.sid and lg.d >= p.f and (p.u is null or lg.d <= p.u) left join nf x on x.sid = lg.sid and x.day = lg.d
), ls as (
  select sid, day, count(slept) as n, sum(slept - target) as balance, bool_or(dflt) as dflt, list(d order by d) filter (where slept is not null) as ds from lt group by 1, 2
), lm as (
  select *, case when n = 0 then 14 else greatest(ds[1] - (day - 13), day - ds[-1], coalesce(list_max(list_transform(range(1, len(ds)), lambda i: ds[i + 1] - ds[i] - 1)), 0)) end as missing from ls
), m_sleep as (
  select sid, day, 'sleep.score' as metric, case when state = 'VALID' then trunc(0.4::double * p_duration + 0.2::double * p_stages + 0.2::double * p_consistency + 0.2::double * p_interruptions) end as value, state as status, 1 + history as n_inputs, 'MEDIUM' as confidence from sc
  union all select nf.sid, nf.day, 'sleep.need_min', coalesce(p.value, 480), case when p.value is null then 'REDUCED' else 'VALID' end, 1, 'MEDIUM' from nf left join prof p on p.sid = nf.sid and nf.day >= p.f and (p.u is null or nf.day <= p.u)
  union all select sid, day, 'sleep.debt_min', case when n >= 10 and missing <= 2 then greatest(0, -balance) end, case when not (n >= 10 and missing <= 2) then 'CALIBRATING' when dflt then 'REDUCED' else 'VALID' end, n, 'MEDIUM' from lm
)"""
M_RECOVERY = """rx as (
  select nf.sid, nf.day, case when rhr between 25 and 240 then rhr end as rate, case when ok and tst between 0.001 and 1440 then tst end as asleep, coalesce(p.value, 480) as target from nf left join prof p on p.sid = nf.sid and nf.day >= p.f and (p.u is null or nf.day <= p.u)
), ry as (select *, list({'d': day, 'v': rate::double}) filter (where rate is not null) over (partition by sid order by day range between 90 preceding and 1 preceding) as every from rx
), rz as (select *, case when len(every) > 30 then every[-30:] else every end as p from ry
), rb as (select *, coalesce(len(p) >= 5 and len(list_filter(p, lambda q: q.d >= day - 30)) >= 5 and day - p[-1].d <= 14, false) as warm, list_avg(list_transform(p, lambda q: q.v)) as mu, list_aggregate(list_transform(p, lambda q: q.v), 'stddev_pop') as sg from rz
), rq as (select *, case when warm then (mu - rate) / greatest(sg, 1.5) end as zr, (asleep / target - 1) / 0.12::double as zs from rb
), m_recovery as (
  select sid, day, 'recovery.score' as metric, case when zr is not null and zs is not null then round_even(100 / (1 + exp(-(1.06::double + 0.85::double * ((zr * 0.25::double + zs * 0.2::double) / 0.45::double)))), 0) end as value,
    case when zr is not null and zs is not null then 'REDUCED' when asleep is null then 'INSUFFICIENT_DATA' when rate is not null and not warm then 'CALIBRATING' else 'INSUFFICIENT_DATA' end as status, 1 + coalesce(len(every), 0) as n_inputs, 'MEDIUM' as confidence from rq
)"""
M_MONITORING = """mn as (
  select sid, day, unnest(['rhr', 'spo2', 'respiratory']) as key, unnest([case when rhr between 25 and 240 then rhr end, case when spo2_mean between 0.001 and 100 then spo2_mean end, case when respiratory between 4 and 60 then respiratory end]) as now from nf
), ms as (
  select mn.*, b.n, b.mean, b.sd, case when now is null then 'NO_DATA' when b.day - b.last_day > 14 then 'STALE' when not coalesce(b.ready, false) then 'CALIBRATING' when now < b.lower then 'BELOW' when now > b.upper then 'ABOVE' else 'IN_RANGE' end as state
  from mn left join bd b on b.sid = mn.sid and b.day = mn.day and b.key = mn.key
), mc as (
  select *, state in ('BELOW', 'ABOVE', 'IN_RANGE') as judged, case key when 'spo2' then now < 92 when 'rhr' then (case when round(sd, 9) >= 0.01 then round((now - mean) / sd, 9) > 1.5 else now > mean + 5 end) else (case when round(sd, 9) >= 0.1 then round((now - mean) / sd, 9) > 1.5 else now > mean + 1.5 end) end as fired from ms
), mw as (select sid, day, count(*) filter (where judged) as ready, count(now) as measured, count(*) filter (where judged and fired) as drivers from mc group by 1, 2
), m_monitoring as (
  select sid, day, 'anomaly.' || key as metric, case when judged then (state = case key when 'spo2' then 'BELOW' else 'ABOVE' end)::int::double end as value, case when judged then (case key when 'respiratory' then 'REDUCED' else 'VALID' end) when state = 'NO_DATA' then 'INSUFFICIENT_DATA' else 'CALIBRATING' end as status,
    1 + coalesce(n, 0) as n_inputs, case key when 'respiratory' then 'LOW' else 'MEDIUM' end as confidence from mc
  union all select sid, day, 'health_signal.physiological_watch', case when ready >= 2 then (drivers >= 2)::int::double end, case when ready >= 2 then 'REDUCED' when measured < 2 then 'INSUFFICIENT_DATA' else 'CALIBRATING' end, 1, 'LOW' from mw
)"""
CUSUM_STEPS = """cs as (select sid, day, case when rhr between 25 and 240 then rhr::double end as v from nf
), cw as (select sid, day, v, list(v) filter (where v is not null) over f as p, stddev_samp(v) over f as sd, count(v) over (partition by sid order by day range between 7 preceding and 1 preceding) as run from cs window f as (partition by sid order by day range between 28 preceding and 1 preceding)
), cm as (select *, list_median(p) as med from cw
), ck as (select *, 1.4826::double * list_median(list_transform(p, lambda x: abs(x - med))) as mad from cm
), cz as (select sid, day, v, coalesce(len(p), 0) as n, case when v is not null and len(p) >= 7 and run >= 7 and round(sd, 9) >= 1 then (v - med) / (case when mad > 0 then mad else sd end) end as z from ck
), ce as (select sid, day, z, row_number() over (partition by sid order by day) as i from cz where z is not null
), ca as (
  select sid, day, i, case when z < 0.5 then 1 else 0 end as nr, greatest(0.0::double, z - 0.5) as s, case when greatest(0.0::double, z - 0.5) > 4 then 1 else 0 end as y from ce where i = 1
  union all
  select sid, day, i, nr, s, case when s > 4 then py + 1 else 0 end as y from (
    select sid, day, i, nr, py, case when nr >= 2 then 0.0 else s0 end as s from (
      select ce.sid, ce.day, ce.i, case when ce.z < 0.5 then (case when ce.day - ca.day > 1 then 0 else ca.nr end) + 1 else 0 end as nr, greatest(0.0::double, (case when ce.day - ca.day > 1 then 0.0 else ca.s end) + ce.z - 0.5) as s0, case when ce.day - ca.day > 1 then 0 else ca.y end as py
      from ca join ce on ce.sid = ca.sid and ce.i = ca.i + 1))
), m_cusum as (
  select cz.sid, cz.day, 'anomaly.rhr_cusum' as metric, case when ca.sid is not null then (ca.y > 0)::int::double end as value, case when ca.sid is not null then 'VALID' when v is null then 'INSUFFICIENT_DATA' else 'CALIBRATING' end as status, 1 + n as n_inputs, 'MEDIUM' as confidence from cz left join ca on ca.sid = cz.sid and ca.day = cz.day
)"""


def _family(name: str, *ctes: str, recursive: bool = False) -> str:
    text = "with recursive " if recursive else "with "
    return text + ", ".join((*FEATURES, *ctes)) + f" select sid, day, metric, status, n_inputs, confidence, round(value, 6) + 0 as value from {name}"


def met_table_direct(spark: SparkSession, d: str) -> DataFrame:
    """MET-01 to MET-07: what a night or a summary gives by itself."""
    return _shown(t.direct(frame(spark, d)))


def met_table_baselines(spark: SparkSession, d: str) -> DataFrame:
    """MET-09 to MET-11: bands, deviations and weighted means of all four signals."""
    return _shown(t.baselines(frame(spark, d)))


def met_table_trends(spark: SparkSession, d: str) -> DataFrame:
    """MET-12: all eighteen trends."""
    return _shown(t.trends(frame(spark, d)))


def met_table_regularity(spark: SparkSession, d: str) -> DataFrame:
    """MET-08: regularity of complete nights."""
    return _shown(t.regularity(frame(spark, d)))


def met_table_sleep(spark: SparkSession, d: str) -> DataFrame:
    """MET-13 to MET-15: score, need and debt."""
    return _shown(t.sleep(frame(spark, d), profiles(spark, d)))


def met_table_recovery(spark: SparkSession, d: str) -> DataFrame:
    """MET-16: recovery (this source has no variability)."""
    return _shown(t.recovery(frame(spark, d)))


def met_table_monitoring(spark: SparkSession, d: str) -> DataFrame:
    """MET-17, MET-18: signals outside their bands on the concerning side, and two of them together."""
    return _shown(t.monitoring(frame(spark, d)))


def met_table_cusum(spark: SparkSession, d: str) -> DataFrame:
    """MET-19, ST-01: change points of the nightly rate."""
    return _shown(t.change_points(frame(spark, d)))


def met_table(spark: SparkSession, d: str) -> DataFrame:
    """MET-01 to MET-19: number of rows and sum of values of each of the metrics by status, from the whole table."""
    nights, dailies = materialize(night_features(spark, d, **RATE)), materialize(day_features(spark, d))
    x = t.metric_table(nights, dailies, profiles(spark, d))
    return x.groupBy("metric", "status").agg(F.count("*").alias("n"), F.sum("n_inputs").alias("inputs"), F.round(F.sum(F.round("value", 6)), 3).alias("total"))


FAMILIES = {
    "met_table_direct": (M_DIRECT,), "met_table_baselines": (SER, BD, M_BASE), "met_table_trends": (SER, M_TRENDS), "met_table_regularity": (M_REGULARITY,), "met_table_sleep": (PROF, M_SLEEP), "met_table_recovery": (PROF, M_RECOVERY),
    "met_table_monitoring": (SER, BD, M_MONITORING), "met_table_cusum": (CUSUM_STEPS,),
}
TABLES = ("m_direct", "m_base", "m_trends", "m_regularity", "m_sleep", "m_recovery", "m_monitoring", "m_cusum")
for _name, _table in zip(FAMILIES, TABLES, strict=True):
    QUERIES[_name] = globals()[_name]
    SQL[_name] = _family(_table, *FAMILIES[_name], recursive=_name == "met_table_cusum")
QUERIES["met_table"] = met_table
SQL["met_table"] = (
    "with recursive " + ", ".join((*FEATURES, *dict.fromkeys(c for cs in FAMILIES.values() for c in cs)))
    + " select metric, status, count(*)::bigint as n, sum(n_inputs)::bigint as inputs, round(sum(round(value, 6)), 3) as total from (" + " union all ".join(f"select metric, status, n_inputs, value from {m}" for m in TABLES) + ") group by 1, 2"
)


@query("select source_table, count(*)::bigint as n from (select unnest(['heart_rate', 'spo2', 'stress', 'steps', 'calories', 'intensity']) as source_table from hr union all select unnest(['sleep', 'sport']) from sleep union all select unnest(['steps_day', 'heart_rate_day', 'spo2_day', 'stress_day', 'calories_day', 'intensity_day', 'valid_stand_day', 'valid_stand', 'vitality', 'sleep_day', 'heart_rate', 'heart_rate']) from days) group by 1", *EXPORT_CTES)
def src_export(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18: raw records of all kinds."""
    return export(spark, d).groupBy("source_table").agg(F.count("*").alias("n"))


AS_OF = 1754006400  # 2025-08-01


def sta_overview(spark: SparkSession, d: str) -> DataFrame:
    """STA-01, STA-02, STA-04, AGG-18, SRT-02: of each device the last night, its freshness, headlines, anomalies and signals."""
    nights, dailies = materialize(night_features(spark, d, **RATE)), materialize(day_features(spark, d))
    x = overview(t.metric_table(nights, dailies, profiles(spark, d)), nights, F.lit(AS_OF // 86400), F.lit(AS_OF + 43200))
    return x.select("sid", "last_night", "freshness", "need_min", "recovery", "recovery_day", "recovery_status", F.concat_ws(",", "active_anomalies").alias("active_anomalies"), "latest_anomaly_day", F.concat_ws(",", "signals_available").alias("signals_available"))


QUERIES["sta_overview"] = sta_overview
SQL["sta_overview"] = (
    "with recursive " + ", ".join((*FEATURES, *dict.fromkeys(c for cs in FAMILIES.values() for c in cs)))
    + f""", ln as (select sid, max(day) as last_night, arg_max(t, (day, t)) as last_end, bool_or(rhr is not null) as a, bool_or(spo2_mean is not null) as b, bool_or(respiratory is not null) as c from nf group by 1
    ), ev as (select sid, day, metric from m_monitoring where value = 1 union all select sid, day, metric from m_cusum where value = 1
    ), rc as (select sid, arg_max({{'v': value, 's': status, 'd': day}}, day) as r from m_recovery group by 1
    ), fx as (select *, case when last_night <> {AS_OF // 86400} then 'HISTORICAL' when last_end > {AS_OF + 43200} or {AS_OF + 43200} - last_end > 129600 then 'STALE' else 'FRESH' end as freshness from ln)
    select fx.sid, last_night, freshness, case when freshness = 'FRESH' then (select any_value(value) from m_sleep n where n.sid = fx.sid and n.day = last_night and metric = 'sleep.need_min') end as need_min, case when freshness = 'FRESH' then rc.r.v end as recovery, rc.r.d as recovery_day, rc.r.s as recovery_status,
      case when freshness = 'FRESH' then coalesce((select string_agg(metric, ',' order by metric) from ev where ev.sid = fx.sid and ev.day = last_night), '') else '' end as active_anomalies, (select max(day) from ev where ev.sid = fx.sid) as latest_anomaly_day,
      array_to_string(list_filter([case when a then 'rhr' end, case when b then 'spo2' end, case when c then 'respiratory' end], lambda x: x is not null), ',') as signals_available from fx left join rc on rc.sid = fx.sid"""
)
