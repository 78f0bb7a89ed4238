"""Features and metrics."""

from __future__ import annotations

from pyspark.sql import Window

from ..functions import numeric
from ..functions.clock import clock_minute
from ..operators import metrics as m
from ..operators.joins import effective
from ..operators.windows import calendar, max_gap, series_in
from .common import DAYS, NIGHTS, SLEEP, DataFrame, F, SparkSession, days, nights, registry
from .feature_queries import PROF, profiles

QUERIES, SQL, query = registry()
r6 = numeric.rounded

BAND = """bands as (
  select *, coalesce(n >= 5 and day - last_day <= 14, false) as ready, greatest(1.65::double * sd, {floor}::double) as half from (
    select sid, day, v, count(v) over w as n, avg(v) over w as mean, stddev_pop(v) over w as sd, max(day) over w as last_day
    from {series} window w as (partition by sid order by day range between 30 preceding and 1 preceding))
)"""
RHR = "rhrs as (select sid, day, rhr::double as v from days where rhr is not null)"


def rhr_series(spark: SparkSession, d: str) -> DataFrame:
    return days(spark, d).filter("rhr is not null").select("sid", "day", "rhr")


@query(
    """select sid, day, round(v, 6) as v, n, round(mean, 6) as mean, round(sd, 6) as sd, case when ready then round(v - mean, 6) + 0 end as deviation,
      case when day - last_day > 14 then 'STALE' when not ready then 'CALIBRATING' when v < mean - half then 'BELOW' when v > mean + half then 'ABOVE' else 'IN_RANGE' end as state from bands""",
    DAYS, RHR, BAND.format(floor="3.0", series="rhrs"),
)
def met_anomaly(spark: SparkSession, d: str) -> DataFrame:
    """WIN-03, MET-09, MET-10, MET-17: which days of each device lie outside its personal band of resting heart rate."""
    b = m.bands(rhr_series(spark, d), "sid", "rhr", m.BANDS["rhr"])
    return b.select("sid", "day", r6(F.col("v")).alias("v"), "n", r6(F.col("mean")).alias("mean"), r6(F.col("sd")).alias("sd"), r6(F.col("deviation")).alias("deviation"), "state")


@query(
    """select sid, day, round(v - mean, 6) + 0 as deviation, round(mean - half, 6) as lower, round(mean + half, 6) as upper from bands where ready""",
    SLEEP, NIGHTS, "resp as (select sid, day, avg_respiratory_rate::double as v from nights where avg_respiratory_rate > 0)", BAND.format(floor="0.8", series="resp"),
)
def met_respiratory_band(spark: SparkSession, d: str) -> DataFrame:
    """MET-06, MET-09, MET-10: band of the nightly respiratory rate."""
    series = nights(spark, d).select("sid", "day", numeric.positive(F.col("avg_respiratory_rate")).alias("rr")).filter("rr is not null")
    return m.bands(series, "sid", "rr", m.BANDS["respiratory"]).filter("ready").select("sid", "day", r6(F.col("deviation")).alias("deviation"), r6(F.col("lower")).alias("lower"), r6(F.col("upper")).alias("upper"))


@query(
    """select sid, day, round(list_reduce(p, lambda a, x: a + (x - a) * (2.0::double / 31)), 6) as ewma from (
      select sid, day, list(v) over w as p, count(v) over w as n, max(day) over w as last_day from rhrs window w as (partition by sid order by day range between 30 preceding and 1 preceding))
    where n >= 5 and day - last_day <= 14""",
    DAYS, RHR,
)
def met_ewma(spark: SparkSession, d: str) -> DataFrame:
    """AGG-12, MET-11: exponentially weighted baseline."""
    return m.ewmas(rhr_series(spark, d), "sid", "rhr").filter("ewma is not null").select("sid", "day", r6(F.col("ewma")).alias("ewma"))


@query(
    """, st as (select sid, day, steps::double as v, day - lag(day) over (partition by sid order by day) as gap from days where steps is not null),
    w as (select unnest([14, 30, 90]) as wd, unnest([7, 14, 30]) as least),
    g as (select a.sid, a.day, wd, count(*) as n from st a, w join st b on b.sid = a.sid and b.day between a.day - wd + 1 and a.day group by a.sid, a.day, wd, least having count(*) >= least and count(*) >= 0.6 * wd),
    h as (select g.*, (select max(c.gap) from st c where c.sid = g.sid and c.day <= g.day and c.day - c.gap >= g.day - wd + 1) as mg from g),
    q as (select h.sid, h.day, h.wd, h.n, median((c.v - b.v) / (c.day - b.day)) as slope from h join st b on b.sid = h.sid and b.day between h.day - wd + 1 and h.day join st c on c.sid = h.sid and c.day > b.day and c.day <= h.day where mg <= 7 group by all)
    select sid, day, wd::int as window_days, n::bigint as n, round(slope * 7, 6) as per_week from q""",
    DAYS,
)
def met_trends(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11, WIN-03, WIN-08, MET-12: robust weekly trends of steps over 14, 30 and 90 days."""
    series = days(spark, d).filter("steps is not null").select("sid", "day", "steps")
    return m.trends(series, ["sid"], "steps").filter("per_week is not null").select("sid", "day", "window_days", "n", r6(F.col("per_week")).alias("per_week"))


CLOCK = """clk as (select sid, day, (((floor((s + off) / 60)::bigint % 1440) + 1440) % 1440)::double as bed, (((floor((t + off) / 60)::bigint % 1440) + 1440) % 1440)::double as wake from nights)"""


@query(
    """, w as (select sid, day, count(*) over w as n, list(bed) over w as beds, list(wake) over w as wakes,
      atan2(sum(sin(bed * pi() / 720)) over w, sum(cos(bed * pi() / 720)) over w) * 720 / pi() as mb, atan2(sum(sin(wake * pi() / 720)) over w, sum(cos(wake * pi() / 720)) over w) * 720 / pi() as mw
      from clk window w as (partition by sid order by day range between 13 preceding and current row)),
    r as (select *, list_transform(beds, lambda x: ((x - mb + 720) - 1440 * floor((x - mb + 720) / 1440)) - 720) as rb, list_transform(wakes, lambda x: ((x - mw + 720) - 1440 * floor((x - mw + 720) / 1440)) - 720) as rw from w)
    select sid, day, n, case when n >= 5 then round((list_aggregate(rb, 'stddev_pop') + list_aggregate(rw, 'stddev_pop')) / 2, 4) end as sigma, case when n >= 5 then 'VALID' else 'CALIBRATING' end as status from r""",
    SLEEP, NIGHTS, CLOCK,
)
def met_regularity(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10, MET-08: circular spread of bed and wake times over 14 nights (the score itself is tested on fixtures)."""
    n = nights(spark, d).select("sid", "day", clock_minute(F.col("s"), F.col("off")).alias("bed"), clock_minute(F.col("t"), F.col("off")).alias("wake"))
    return m.regularity(n, "sid", "bed", "wake").select("sid", "day", "n", r6(F.col("sigma"), 4).alias("sigma"), "status")


TARGETS = PROF + """, tgt as (select n.sid, n.day, n.s, n.t, coalesce(p.value, 480.0::double) as target from nights n left join prof p on p.sid = n.sid and n.day >= p.f and (p.u is null or n.day <= p.u))"""


@query(
    """, lg as (select n.sid, n.day, n.day - 13 + k as d from nights n, (select unnest(range(14)) as k)),
    lt as (select lg.sid, lg.day, lg.d, coalesce(p.value, 480) as target, p.value is null as dflt, case when (x.t - x.s) / 60.0 <= 1440 then (x.t - x.s)::double / 60 end as slept from lg left join prof p on p.sid = lg.sid and lg.d >= p.f and (p.u is null or lg.d <= p.u) left join nights x on x.sid = lg.sid and x.day = lg.d),
    ls as (select sid, day, count(slept) as n, sum(slept - target) as bal, bool_or(dflt) as dflt, list(d order by d) filter (where slept is not null) as ds from lt group by 1, 2),
    g as (select *, case when n = 0 then 14 else greatest(ds[1] - (day - 13), day - ds[-1], coalesce(list_max(list_transform(range(1, len(ds)), lambda i: ds[i + 1] - ds[i] - 1)), 0)) end as mis from ls)
    select sid, day, n, mis::bigint as longest_missing, case when n >= 10 and mis <= 2 then round(greatest(0, -bal), 6) end as debt_min,
      case when not (n >= 10 and mis <= 2) then 'CALIBRATING' when dflt then 'REDUCED' else 'VALID' end as status from g""",
    SLEEP, NIGHTS, PROF,
)
def met_sleep_debt(spark: SparkSession, d: str) -> DataFrame:
    """WIN-06, JN-04, JN-07, MET-14, MET-15: sleep debt over 14 calendar nights, each with the target in force on it."""
    n = nights(spark, d).select("sid", "day", ((F.col("t") - F.col("s")) / 60.0).alias("tst"))
    cal = effective(m.ledger(n, "sid"), profiles(spark, d), ["sid"], "sleep_target_min", "day").join(n, ["sid", "day"], "left")
    cal = cal.withColumns({"target": m.sleep_target(F.col("sleep_target_min")), "dflt": F.col("sleep_target_min").isNull()})
    return m.sleep_debt(cal, "sid", "tst", "target", "dflt").withColumn("debt_min", r6(F.col("debt_min")))


@query(
    """, x as (select g.sid, g.day, case when d.rhr between 25 and 240 then d.rhr end as rhr, case when (t - s) / 60.0 between 0.001 and 1440 then (t - s)::double / 60 end as asleep, target from tgt g left join days d on d.sid = g.sid and d.day = g.day),
    w as (select *, list({'d': day, 'v': rhr::double}) filter (where rhr is not null) over (partition by sid order by day range between 90 preceding and 1 preceding) as p0 from x),
    l as (select *, case when len(p0) > 30 then p0[-30:] else p0 end as p from w),
    b as (select *, coalesce(len(p) >= 5 and len(list_filter(p, lambda q: q.d >= day - 30)) >= 5 and day - p[-1].d <= 14, false) as ok, list_avg(list_transform(p, lambda q: q.v)) as mu, list_aggregate(list_transform(p, lambda q: q.v), 'stddev_pop') as sd from l),
    z as (select *, case when ok then (mu - rhr) / greatest(sd, 1.5) end as zr, (asleep / target - 1) / 0.12::double as zs from b)
    select sid, day, cast(null as double) as z_hrv, round(zr, 6) as z_rhr, round(zs, 6) as z_sleep,
      case when zr is not null and zs is not null then round_even(100 / (1 + exp(-(1.06::double + 0.85::double * ((zr * 0.25::double + zs * 0.2::double) / 0.45::double)))), 0) end as score,
      case when zr is not null and zs is not null then 'REDUCED' when asleep is null then 'INSUFFICIENT_DATA' when rhr is not null and not ok then 'CALIBRATING' else 'INSUFFICIENT_DATA' end as status from z""",
    SLEEP, NIGHTS, TARGETS, DAYS,
)
def met_recovery(spark: SparkSession, d: str) -> DataFrame:
    """WIN-04, MET-16: recovery from resting heart rate and sleep (this source has no variability)."""
    n = effective(nights(spark, d), profiles(spark, d), ["sid"], "sleep_target_min", "day").join(days(spark, d).select("sid", "day", "rhr"), ["sid", "day"], "left")
    n = n.select("sid", "day", F.lit(None).cast("double").alias("rmssd"), "rhr", ((F.col("t") - F.col("s")) / 60.0).alias("asleep"), F.col("sleep_target_min").alias("target"))
    out = m.recovery(n, "sid", hrv="rmssd", rhr="rhr", asleep="asleep", target="target")
    return out.select("sid", "day", *[r6(F.col(c)).alias(c) for c in ("z_hrv", "z_rhr", "z_sleep")], "score", "status")


@query(
    """, w as (select sid, day, v, list(v) over f as p, stddev_samp(v) over f as sd, count(v) over (partition by sid order by day range between 7 preceding and 1 preceding) as run from rhrs window f as (partition by sid order by day range between 28 preceding and 1 preceding)),
    c as (select *, list_median(p) as med from w), k as (select *, 1.4826::double * list_median(list_transform(p, lambda x: abs(x - med))) as mad from c),
    z as (select sid, day, case when len(p) >= 7 and run >= 7 and round(sd, 9) >= 1 then (v - med) / (case when mad > 0 then mad else sd end) end as z from k),
    e as (select sid, day, z, row_number() over (partition by sid order by day) as i from z where z is not null),
    recursive_f as (select 1)
    select sid, day, round(z, 6) as z, z is not null as evaluated from z""".replace(",\n    recursive_f as (select 1)", ""),
    DAYS, RHR,
)
def met_cusum_z(spark: SparkSession, d: str) -> DataFrame:
    """ST-01, AGG-09, WIN-07: the stateless part of the change-point detector."""
    return m.cusum(rhr_series(spark, d), "sid", "rhr").select("sid", "day", r6(F.col("z")).alias("z"), F.col("z").isNotNull().alias("evaluated"))


@query(
    "with recursive " + ", ".join([DAYS, RHR]) + """, w as (select sid, day, v, list(v) over f as p, stddev_samp(v) over f as sd, count(v) over (partition by sid order by day range between 7 preceding and 1 preceding) as run from rhrs window f as (partition by sid order by day range between 28 preceding and 1 preceding)),
    c as (select *, list_median(p) as med from w), k as (select *, 1.4826::double * list_median(list_transform(p, lambda x: abs(x - med))) as mad from c),
    z as (select sid, day, case when len(p) >= 7 and run >= 7 and round(sd, 9) >= 1 then (v - med) / (case when mad > 0 then mad else sd end) end as z from k),
    e as (select sid, day, z, row_number() over (partition by sid order by day) as i from z where z is not null),
    a as (
      select sid, day, i, case when z < 0.5 then 1 else 0 end as nr, greatest(0.0::double, z - 0.5) as s, case when greatest(0.0::double, z - 0.5) > 4 then 1 else 0 end as y from e where i = 1
      union all
      select sid, day, i, nr, s, case when s > 4 then py + 1 else 0 end as y from (
        select sid, day, i, nr, py, case when nr >= 2 then 0.0 else s0 end as s from (
          select e.sid, e.day, e.i, case when e.z < 0.5 then (case when e.day - a.day > 1 then 0 else a.nr end) + 1 else 0 end as nr, greatest(0.0::double, (case when e.day - a.day > 1 then 0.0 else a.s end) + e.z - 0.5) as s0, case when e.day - a.day > 1 then 0 else a.y end as py
          from a join e on e.sid = a.sid and e.i = a.i + 1))
    )
    select z.sid, z.day, round(a.s, 6) as cusum, case when a.sid is null then 'UNEVALUATED' when a.y = 0 then 'GREEN' when a.y = 1 then 'YELLOW' else 'RED' end as state from z left join a on a.sid = z.sid and a.day = z.day"""
)
def met_cusum(spark: SparkSession, d: str) -> DataFrame:
    """ST-01, MET-19: change points of resting heart rate."""
    return m.cusum(rhr_series(spark, d), "sid", "rhr").select("sid", "day", r6(F.col("cusum")).alias("cusum"), "state")


@query(
    """select sid, day, n, longest_gap from (select sid, day, count(*) over w as n, list(day) over w as ds from rhrs window w as (partition by sid order by day range between 29 preceding and current row)),
      lateral (select case when len(ds) > 1 then list_max(list_transform(range(1, len(ds)), lambda i: ds[i + 1] - ds[i])) end as longest_gap)""",
    DAYS, RHR,
)
def win_calendar_gaps(spark: SparkSession, d: str) -> DataFrame:
    """WIN-03, WIN-08: observations and largest gap in a calendar window."""
    s = rhr_series(spark, d).withColumn("p", series_in(calendar(["sid"], "day", -29, 0), "day", "rhr"))
    return s.select("sid", "day", F.size("p").cast("bigint").alias("n"), max_gap(F.col("p")).alias("longest_gap"))


@query("select sid, day, list_transform(case when len(p) > 30 then p[-30:] else p end, lambda x: x)[1] as oldest, least(len(p), 30)::bigint as n from (select sid, day, list(v) over (partition by sid order by day range between 90 preceding and 1 preceding) as p from rhrs) where len(p) > 0", DAYS, RHR)
def win_last_n(spark: SparkSession, d: str) -> DataFrame:
    """WIN-04: the latest 30 readings of the last 90 days."""
    s = rhr_series(spark, d).withColumn("p", series_in(calendar(["sid"], "day", -90, -1), "day", "rhr")).filter("size(p) > 0")
    s = s.withColumn("q", F.slice("p", F.greatest(F.size("p") - 29, F.lit(1)), F.lit(30)))
    return s.select("sid", "day", F.element_at("q", 1)["v"].alias("oldest"), F.size("q").cast("bigint").alias("n"))


@query("select sid, day, count(*) over (partition by sid order by day range between 7 preceding and 1 preceding) = 7 as contiguous, count(*) over (partition by sid order by day rows between unbounded preceding and 1 preceding) >= 14 as warm from rhrs", DAYS, RHR)
def win_contiguous(spark: SparkSession, d: str) -> DataFrame:
    """WIN-07, WIN-12: seven observed days in a row before; enough earlier observations."""
    week = F.count("*").over(calendar(["sid"], "day", -7, -1))
    prior = F.count("*").over(Window.partitionBy("sid").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return rhr_series(spark, d).select("sid", "day", (week == 7).alias("contiguous"), (prior >= 14).alias("warm"))


@query(
    """, mx as (select max(day) as as_of from days), lst as (select sid, arg_max(rhr, day) as rhr, max(day) as day from days where rhr is not null group by sid)
    select sid, day, case when as_of - day <= 1 then 'FRESH' else 'STALE' end as freshness, case when as_of - day <= 1 then rhr end as resting_hr from lst, mx""",
    DAYS,
)
def sta_headline(spark: SparkSession, d: str) -> DataFrame:
    """STA-01, STA-02, SRT-02: the latest value of each device, shown as a number only while fresh."""
    x = days(spark, d)
    last = x.filter("rhr is not null").groupBy("sid").agg(F.max_by("rhr", "day").alias("rhr"), F.max("day").alias("day"))
    fresh = F.col("as_of") - F.col("day") <= 1
    return last.join(F.broadcast(x.agg(F.max("day").alias("as_of"))), F.lit(True)).select("sid", "day", F.when(fresh, "FRESH").otherwise("STALE").alias("freshness"), F.when(fresh, F.col("rhr")).alias("resting_hr"))  # one row
