"""Scans, cleaning, identity, aggregates, sets, profiles and checks."""

from __future__ import annotations

from pyspark.sql import Window

from ..functions import clock, identity, numeric
from ..operators.joins import as_of, effective, interval_join
from ..operators.statistics import MAD_SCALE, nearest_ranks, percentile
from ..operators.windows import runs, trailing_sum, with_next, with_previous
from ..sources.adapter import CAPABILITIES
from .common import DAYS, HR, NIGHTS, SLEEP, DataFrame, F, SparkSession, days, instants, nights, registry, samples, sessions, table
from .feature_queries import PROF, profiles
from .store import cutoff

QUERIES, SQL, query = registry()
r6 = numeric.rounded

# scans
@query("select source_record_id, sid, ts, bpm from hr where ts >= (select (max(ts) - 172800) // 86400 * 86400 from hr)", HR)
def src_cutoff_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-09: samples from the start of the day that is 48 hours before the last one; records without an instant drop out."""
    last = instants(spark, d).agg(F.max("ts")).first()[0]  # one number
    if last is None:
        return samples(spark, d).select("source_record_id", "sid", "ts", "bpm")
    return samples(spark, d, F.col("ts") >= cutoff(last)).select("source_record_id", "sid", "ts", "bpm")


@query(
    """select source_record_id, sid, ts, bpm, case when bpm between 25 and 240 then 'VALID' else 'INVALID' end as quality
    from hr where bpm is not null and ts >= 1748736000 and ts < 1751328000""",
    HR,
)
def src_range_read(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10, CLN-12: samples of June 2025 (half-open range) with their quality; implausible ones stay, marked."""
    hr = samples(spark, d, (F.col("ts") >= 1748736000) & (F.col("ts") < 1751328000)).filter("bpm is not null")
    return hr.select("source_record_id", "sid", "ts", "bpm", F.when(F.col("bpm").between(25, 240), "VALID").otherwise("INVALID").alias("quality"))


@query(
    """select source_record_id, sid, s, t, day, case when is_nap_inferred = 1 then 'nap' else 'main' end as session_kind,
      case when has_stages = 1 then 'VENDOR_DERIVED' else 'STAGE_INCOMPLETE,VENDOR_DERIVED' end as flags,
      case when avg_respiratory_rate > 0 then avg_respiratory_rate end as respiratory, case when avg_respiratory_rate > 0 then 'PARTIAL' end as respiratory_quality
    from sleep""",
    SLEEP,
)
def src_sleep_sessions(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11, SRC-15: sessions with kind and flags; a respiratory rate of zero or less is none."""
    rr = numeric.positive(F.col("avg_respiratory_rate"))
    flags = F.array_sort(F.array_compact(F.array(F.lit("VENDOR_DERIVED"), F.when(F.col("has_stages") != 1, "STAGE_INCOMPLETE"))))
    return sessions(spark, d).select(
        "source_record_id", "sid", "s", "t", "day", F.when(F.col("is_nap_inferred") == 1, "nap").otherwise("main").alias("session_kind"), F.concat_ws(",", flags).alias("flags"),
        rr.alias("respiratory"), F.when(rr.isNotNull(), "PARTIAL").alias("respiratory_quality"),
    )


@query("select sid, day, steps, calories, active, stands, rhr, cast(null as double) as distance from days", DAYS)
def src_daily_activity(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13, SRC-14, SNK-02: daily activity; zero steps are observed, a resting heart rate of zero is none, distance has no known unit."""
    return days(spark, d).select("sid", "day", "steps", "calories", "active", "stands", "rhr", F.lit(None).cast("double").alias("distance"))


@query("select n_sources, sha256(last_run || chr(0) || policy || chr(0) || prints) as generation from (select count(*)::bigint as n_sources, string_agg(coalesce(last_fingerprint, '?'), ',' order by source_key) as prints from source_databases), (select arg_max(generation_id, (scanned_at, generation_id)) as last_run, arg_max(conflict_policy_version, (scanned_at, generation_id)) as policy from source_generations)")
def src_generation(spark: SparkSession, d: str) -> DataFrame:
    """SRC-20, REC-11: a generation is the hash of the last run, its policy, and the fingerprints of all sources in order."""
    prints = F.transform(F.array_sort(F.collect_list(F.struct("source_key", F.coalesce("last_fingerprint", F.lit("?")).alias("f")))), lambda x: x["f"])
    sources = table(spark, d, "source_databases").agg(F.count("*").alias("n_sources"), F.concat_ws(",", prints).alias("prints"))
    last = table(spark, d, "source_generations").agg(F.max(F.struct("scanned_at", "generation_id", "conflict_policy_version")).alias("r"))
    return sources.join(F.broadcast(last), F.lit(True)).select("n_sources", F.sha2(F.concat_ws("\u0000", "r.generation_id", "r.conflict_policy_version", "prints"), 256).alias("generation"))  # one row each


@query("select * from (values " + ", ".join(f"('{k}', {str(s).lower()}, {'null' if o is None else repr(o)}, {'null' if r is None else r})" for k, s, o, r in CAPABILITIES) + ") c(kind, supported, origin, resolution_s)")
def src_capability_dim(spark: SparkSession, d: str) -> DataFrame:
    """SRC-19: what the source can give."""
    return spark.createDataFrame(CAPABILITIES, "kind string, supported boolean, origin string, resolution_s int")


@query("select source_db_id, source_key, relative_path from source_databases where not contains(relative_path, '.conflict-')")
def src_without_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """SRC-02: sources without conflict copies."""
    return table(spark, d, "source_databases", "source_db_id", "source_key", "relative_path").filter(~identity.conflict_copy(F.col("relative_path")))


# cleaning and identity
@query(
    """select physical_record_id, last_seen_generation, count(*)::bigint as n, max(case when regexp_full_match(trim(b), '[+-]?[0-9]+') then try_cast(trim(b) as bigint) end) as bpm_int,
      max(try_cast(trim(b) as double)) as bpm_float
    from (select *, case when json_valid(value_json) then json_extract_string(value_json, '$.bpm') end as b from physical_records) group by 1, 2"""
)
def cln_safe_cast_json(spark: SparkSession, d: str) -> DataFrame:
    """CLN-01, CLN-02, CLN-03: integers and doubles out of JSON that may be broken."""
    b = F.try_variant_get(F.try_parse_json("value_json"), "$.bpm", "string")
    p = table(spark, d, "physical_records", "physical_record_id", "last_seen_generation", "value_json").withColumn("b", b)
    return p.groupBy("physical_record_id", "last_seen_generation").agg(F.count("*").alias("n"), F.max(numeric.as_int(F.col("b"))).alias("bpm_int"), F.max(numeric.as_float(F.col("b"))).alias("bpm_float"))


@query("select sid, make_timestamp((ts + off) * 1000000)::date as local_date, count(*)::bigint as n from hr group by 1, 2", HR)
def cln_local_date(spark: SparkSession, d: str) -> DataFrame:
    """CLN-10: local dates of samples."""
    return samples(spark, d).groupBy("sid", clock.local_date(F.col("ts"), F.col("off")).alias("local_date")).agg(F.count("*").alias("n"))


@query("select source_record_id, make_timestamp((t - 1 + off) * 1000000)::date as sleep_date, ((floor((t + off) / 60)::bigint % 1440) + 1440) % 1440 as wake_minute, ((floor((s + off) / 60)::bigint % 1440) + 1440) % 1440 as bed_minute from sleep", SLEEP)
def cln_sleep_date(spark: SparkSession, d: str) -> DataFrame:
    """CLN-16, CLN-21: sleep dates and clock minutes of going to bed and waking."""
    off = F.col("off")
    return sessions(spark, d).select("source_record_id", clock.sleep_date(F.col("t"), off).alias("sleep_date"), clock.clock_minute(F.col("t"), off).alias("wake_minute"), clock.clock_minute(F.col("s"), off).alias("bed_minute"))


@query(
    """select source_db_id, case when relative_path ~ '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$' and regexp_extract(relative_path, '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$', 1) = regexp_extract(relative_path, '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$', 3)
      then 'account:' || regexp_extract(relative_path, '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$', 1) || ':region:' || regexp_extract(relative_path, '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$', 2) else relative_path end as key,
      source_key, contains(relative_path, '.conflict-') as conflict_copy from source_databases""".replace("relative_path ~ '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$'", "regexp_matches(relative_path, '(?i)([^/]+)/([a-z]{2})/([^/]+)\\.db$')")
)
def cln_source_key(spark: SparkSession, d: str) -> DataFrame:
    """CLN-09: keys of sources that stay when folders move."""
    path = F.col("relative_path")
    return table(spark, d, "source_databases").select("source_db_id", identity.source_key(path).alias("key"), "source_key", identity.conflict_copy(path).alias("conflict_copy"))


@query(
    """select physical_record_id, last_seen_generation, sha256('heart_rate|{"logical_record_id":"' || logical_record_id || '"}') as logical,
      sha256(source_db_id::varchar || '|' || sha256('heart_rate|{"logical_record_id":"' || logical_record_id || '"}')) as physical, count(*)::bigint as n from physical_records group by 1, 2, 3, 4"""
)
def cln_identity(spark: SparkSession, d: str) -> DataFrame:
    """CLN-04, CLN-06, CLN-08: logical and physical ids from canonical JSON of the key."""
    logical = identity.logical_id(F.col("source_table"), {"logical_record_id": F.col("logical_record_id")})
    p = table(spark, d, "physical_records", "physical_record_id", "last_seen_generation", "source_table", "logical_record_id", "source_db_id")
    return p.groupBy("physical_record_id", "last_seen_generation", logical.alias("logical"), identity.physical_id(F.col("source_db_id").cast("string"), logical).alias("physical")).agg(F.count("*").alias("n"))


@query(
    """select date_trunc('day', x)::date as date, case when x is null then 'MISSING' when make_timestamp((t - 1 + off) * 1000000)::date <> date '2025-06-15' then 'HISTORICAL'
      when t > 1750003200 or 1750003200 - t > 129600 then 'STALE' else 'FRESH' end as freshness, count(*)::bigint as n
    from (select *, make_timestamp((t - 1 + off) * 1000000) as x from sleep) group by 1, 2""",
    SLEEP,
)
def cln_freshness(spark: SparkSession, d: str) -> DataFrame:
    """CLN-17: freshness of nights as of a given instant, for a requested date."""
    date = clock.sleep_date(F.col("t"), F.col("off"))
    fresh = clock.freshness(date, F.lit("2025-06-15").cast("date"), F.col("t"), F.lit(1750003200), F.lit(True))
    return sessions(spark, d).groupBy(date.alias("date"), fresh.alias("freshness")).agg(F.count("*").alias("n"))


# aggregates
@query(
    """, m as (select n.sid, n.day, h.ts // 60 as minute, avg(h.bpm) as v from nights n join hr h on h.sid = n.sid and h.ts >= n.s and h.ts < n.t where h.bpm between 25 and 240 group by 1, 2, 3),
    w as (select *, avg(v) over f as a, count(*) over f as c, minute - lag(minute) over (partition by sid, day order by minute) as gap from m window f as (partition by sid, day order by minute range between current row and 119 following))
    select sid, day, count(*)::bigint as minutes, max(gap)::bigint as max_gap, round(min(case when c >= 12 then a end), 6) as lowest_mean from w group by 1, 2""",
    HR, SLEEP, NIGHTS,
)
def agg_minute_mean_min(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01 to AGG-04, WIN-05: minute means within the night, the lowest mean of a forward window that is covered enough, the largest gap.

    Width (120 minutes) and coverage (12) are parameters; readings here come every five minutes.
    """
    inside = interval_join(samples(spark, d).filter("bpm between 25 and 240").select("sid", "ts", "bpm"), nights(spark, d).select("sid", "day", "s", "t"), ["sid"], "ts", "s", "t")
    minute = inside.groupBy("sid", "day", F.floor(F.col("ts") / 60).alias("minute")).agg(F.avg("bpm").alias("v"))
    w = Window.partitionBy("sid", "day").orderBy("minute")
    ahead = w.rangeBetween(0, 119)
    m = minute.withColumn("a", F.when(F.count("*").over(ahead) >= 12, F.avg("v").over(ahead))).withColumn("gap", F.col("minute") - F.lag("minute").over(w))
    return m.groupBy("sid", "day").agg(F.count("*").alias("minutes"), F.max("gap").alias("max_gap"), r6(F.min("a")).alias("lowest_mean"))


@query(
    """select sid, ts // 86400 as day, count(*)::bigint as n, (max(ts) - min(ts)) / 60.0::double as span_min,
      case when count(*) >= 6 and max(ts) - min(ts) >= 14400 then round(avg(bpm), 6) end as mean, case when count(*) >= 12 and max(ts) - min(ts) >= 14400 then min(bpm) end as lowest,
      case when count(*) >= 12 and max(ts) - min(ts) >= 14400 then round(quantile_cont(bpm, 0.1), 6) end as p10, round(median(bpm), 6) as median, round(stddev_pop(bpm), 6) as sd_pop, round(stddev_samp(bpm), 6) as sd_samp
    from hr where bpm between 25 and 240 group by 1, 2""",
    HR,
)
def agg_gated_distribution(spark: SparkSession, d: str) -> DataFrame:
    """AGG-05 to AGG-08: distribution of a day's readings, given only if there are enough over a long enough span."""
    n, span = F.count("*"), F.max("ts") - F.min("ts")
    gate = lambda least, value: F.when((n >= least) & (span >= 14400), value)
    return samples(spark, d).filter("bpm between 25 and 240").groupBy("sid", F.floor(F.col("ts") / 86400).alias("day")).agg(
        n.alias("n"), (span / 60.0).alias("span_min"), gate(6, r6(F.avg("bpm"))).alias("mean"), gate(12, F.min("bpm")).alias("lowest"), gate(12, r6(percentile("bpm", 0.1))).alias("p10"),
        r6(F.median("bpm")).alias("median"), r6(F.stddev_pop("bpm")).alias("sd_pop"), r6(F.stddev_samp("bpm")).alias("sd_samp"),
    )


@query("select status, source_table, count(*)::bigint as n, count(distinct logical_record_id)::bigint as records from physical_records group by 1, 2")
def agg_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-14, AGG-21, STA-04: counts by status."""
    return table(spark, d, "physical_records", "status", "source_table", "logical_record_id").groupBy("status", "source_table").agg(F.count("*").alias("n"), F.count_distinct("logical_record_id").alias("records"))


@query("select sid, ts // 1800 as bin, count(*)::bigint as n from hr where bpm >= 25 group by 1, 2 having count(*) >= 5", HR)
def agg_having_bins(spark: SparkSession, d: str) -> DataFrame:
    """AGG-15: time bins with enough plausible readings."""
    return samples(spark, d).filter("bpm >= 25").groupBy("sid", F.floor(F.col("ts") / 1800).alias("bin")).agg(F.count("*").alias("n")).filter("n >= 5")


@query(
    """, r as (select sid, bpm, row_number() over (partition by sid order by bpm) - 1 as i, count(*) over (partition by sid) as n from hr where bpm is not null),
    p as (select unnest([10, 25, 50, 75, 90, 95, 99]) as p)
    select sid, p::int as p, bpm as value from r, p where i = round_even((n - 1) * p / 100.0, 0)::bigint""",
    HR,
)
def agg_nearest_rank(spark: SparkSession, d: str) -> DataFrame:
    """AGG-16: nearest-rank quantiles; ranks are rounded half to even."""
    return nearest_ranks(samples(spark, d).select("sid", "bpm"), ["sid"], "bpm", (10, 25, 50, 75, 90, 95, 99)).drop("n")


@query(
    """select sid, count(*)::bigint as n, sum((bpm is null)::int)::bigint as nulls, sum((bpm < 25)::int)::bigint as low, sum((bpm > 240)::int)::bigint as high, min(ts) as first_ts, max(ts) as last_ts,
      count(distinct ts // 60)::bigint as minutes from hr group by sid""",
    HR,
)
def agg_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """AGG-03, AGG-18, AGG-19: checkpoints, null and range counts, measured minutes of each device."""
    return samples(spark, d).groupBy("sid").agg(
        F.count("*").alias("n"), F.count_if(F.col("bpm").isNull()).alias("nulls"), F.count_if(F.col("bpm") < 25).alias("low"), F.count_if(F.col("bpm") > 240).alias("high"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_distinct(F.floor(F.col("ts") / 60)).alias("minutes"),
    )


@query(
    """, m as (select sid, median(rhr) as med from days where rhr is not null group by sid)
    select d.sid, round(any_value(med), 6) as med, round(1.4826 * median(abs(rhr - med)), 6) as mad from days d join m on m.sid = d.sid where rhr is not null group by d.sid""",
    DAYS,
)
def agg_mad(spark: SparkSession, d: str) -> DataFrame:
    """AGG-07, AGG-09: median and scaled median absolute deviation of a device's resting heart rate."""
    v = days(spark, d).filter("rhr is not null").select("sid", "rhr")
    m = v.groupBy("sid").agg(F.median("rhr").alias("med"))
    return v.join(m, "sid").groupBy("sid").agg(r6(F.max("med")).alias("med"), r6(F.median(F.abs(F.col("rhr") - F.col("med"))) * MAD_SCALE).alias("mad"))


# joins
@query(
    "select n.sid, n.day, count(*)::bigint as n, round(avg(h.bpm), 6) as mean from nights n join hr h on h.sid = n.sid and h.ts >= n.s and h.ts < n.t group by 1, 2",
    HR, SLEEP, NIGHTS,
)
def join_interval(spark: SparkSession, d: str) -> DataFrame:
    """JN-01: samples within the night."""
    inside = interval_join(samples(spark, d).select("sid", "ts", "bpm"), nights(spark, d).select("sid", "day", "s", "t"), ["sid"], "ts", "s", "t")
    return inside.groupBy("sid", "day").agg(F.count("*").alias("n"), r6(F.avg("bpm")).alias("mean"))


@query(
    "select n.source_record_id, count(h.ts)::bigint as n from sleep n left join hr h on h.sid = n.sid and h.ts >= n.s and h.ts < n.t group by 1",
    HR, SLEEP,
)
def join_interval_left(spark: SparkSession, d: str) -> DataFrame:
    """JN-02: sessions with the number of samples in them, also none."""
    joined = interval_join(samples(spark, d).select("sid", "ts"), sessions(spark, d).select("source_record_id", "sid", "s", "t"), ["sid"], "ts", "s", "t", how="left")
    return joined.groupBy("source_record_id").agg(F.count("ts").alias("n"))


@query(
    """, st as (select sid, s, max(t) as t from sleep where is_nap_inferred = 0 group by 1, 2)
    select h.sid, count(*)::bigint as n, sum(coalesce((h.ts < x.t)::int, 0))::bigint as asleep from hr h asof left join st x on h.sid = x.sid and h.ts >= x.s group by h.sid""",
    HR, SLEEP,
)
def join_asof(spark: SparkSession, d: str) -> DataFrame:
    """JN-03: samples against the latest main sleep that began before, in one merged order."""
    main = sessions(spark, d).filter("is_nap_inferred = 0").select("sid", "s", "t")
    j = as_of(samples(spark, d).select("sid", "ts"), main, ["sid"], "ts", "s", ["t"])
    return j.groupBy("sid").agg(F.count("*").alias("n"), F.sum(F.coalesce((F.col("ts") < F.col("t")).cast("int"), F.lit(0))).alias("asleep"))


@query("select d.sid, d.day, p.value as sleep_target_min from days d left join prof p on p.sid = d.sid and d.day >= p.f and (p.u is null or d.day <= p.u)", DAYS, SLEEP, PROF)
def join_effective(spark: SparkSession, d: str) -> DataFrame:
    """JN-04, CLN-20, MET-14: the value in force on each day in the profile of the day's subject."""
    return effective(days(spark, d).select("sid", "day"), profiles(spark, d), ["sid"], "sleep_target_min", "day")


@query("select n.sid, n.day, n.t, d.rhr from nights n left join days d on d.sid = n.sid and d.day = n.day", SLEEP, NIGHTS, DAYS)
def join_night_rhr(spark: SparkSession, d: str) -> DataFrame:
    """JN-06, SRT-04: nights with the same day's resting heart rate."""
    return nights(spark, d).select("sid", "day", "t").join(days(spark, d).select("sid", "day", "rhr"), ["sid", "day"], "left")


@query("select sid, day from days semi join (select distinct sid as s2, day as d2 from sleep) x on x.s2 = sid and x.d2 = day", DAYS, SLEEP)
def join_semi_probe(spark: SparkSession, d: str) -> DataFrame:
    """JN-13: days with any sleep session."""
    return days(spark, d).select("sid", "day").join(sessions(spark, d).select("sid", "day"), ["sid", "day"], "left_semi")


# windows over samples
@query(
    """select sid, case when gap is null then 'first' when gap = 0 then '0' when gap <= 60 then '1-60' when gap <= 300 then '61-300' when gap <= 600 then '301-600' when gap <= 3600 then '601-3600' else '>3600' end as bucket,
      count(*)::bigint as n from (select sid, ts - lag(ts) over (partition by sid order by ts) as gap from hr) group by 1, 2""",
    HR,
)
def win_lag_buckets(spark: SparkSession, d: str) -> DataFrame:
    """WIN-01, WIN-11: sampling intervals in labelled ranges."""
    label = F.when(F.col("gap").isNull(), "first").when(F.col("gap") == 0, "0").when(F.col("gap") <= 60, "1-60").when(F.col("gap") <= 300, "61-300").when(F.col("gap") <= 600, "301-600").when(F.col("gap") <= 3600, "601-3600").otherwise(">3600")
    timed = with_previous(samples(spark, d).select("sid", "ts"), ["sid"], "ts").withColumn("gap", F.col("ts") - F.col("previous"))
    return timed.groupBy("sid", label.alias("bucket")).agg(F.count("*").alias("n"))


@query(
    """, g as (select sid, ts, case when ts - lag(ts) over (partition by sid order by ts) between 1 and 400 then 0 else 1 end as st from hr),
    r as (select sid, ts, sum(st) over (partition by sid order by ts rows unbounded preceding) as run from g), k as (select sid, run, count(*) as n, max(ts) - min(ts) as span from r group by 1, 2)
    select sid, count(*)::bigint as runs, max(n)::bigint as longest, max(span)::bigint as longest_span, sum((n >= 30)::int)::bigint as dense from k group by sid""",
    HR,
)
def win_islands(spark: SparkSession, d: str) -> DataFrame:
    """WIN-02: dense runs of samples; a repeated instant breaks a run."""
    k = runs(samples(spark, d).select("sid", "ts"), ["sid"], "ts", 1, 400).groupBy("sid", "run").agg(F.count("*").alias("n"), (F.max("ts") - F.min("ts")).alias("span"))
    return k.groupBy("sid").agg(F.count("*").alias("runs"), F.max("n").alias("longest"), F.max("span").alias("longest_span"), F.count_if(F.col("n") >= 30).alias("dense"))


@query("select sid, max(c)::bigint as most from (select sid, count(*) over (partition by sid order by ts range between 1799 preceding and current row) as c from hr) group by sid", HR)
def win_most_in_half_hour(spark: SparkSession, d: str) -> DataFrame:
    """WIN-13: most samples in any 30 minutes."""
    counted = samples(spark, d).groupBy("sid", "ts").agg(F.count("*").alias("n"))
    return trailing_sum(counted, ["sid"], "ts", "n", 1800).groupBy("sid").agg(F.max("total").alias("most"))


@query("select sid, day, source_record_id, s, t from nights", SLEEP, NIGHTS)
def win_top1_main(spark: SparkSession, d: str) -> DataFrame:
    """WIN-09: the main night of each day in a composite order."""
    return nights(spark, d).select("sid", "day", "source_record_id", "s", "t")


@query("select source_record_id, sid, s, t, next_s, coalesce(next_s < t, false) as overlaps from (select *, lead(s) over (partition by sid order by s, t, source_record_id) as next_s from sleep)", SLEEP)
def win_overlap(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10, PRF-03: sessions that overlap the next one."""
    return with_next(sessions(spark, d), ["sid"], "s", ["s", "t", "source_record_id"], out="next_s").select("source_record_id", "sid", "s", "t", "next_s", F.coalesce(F.col("next_s") < F.col("t"), F.lit(False)).alias("overlaps"))


# sorts and sets
@query("select source_record_id, sid, s, t from sleep order by t desc, source_record_id desc limit 1", SLEEP)
def srt_latest(spark: SparkSession, d: str) -> DataFrame:
    """SRT-02: the latest session of all."""
    return sessions(spark, d).select("source_record_id", "sid", "s", "t").orderBy(F.desc("t"), F.desc("source_record_id")).limit(1)


@query("select bpm, count(*)::bigint as n from hr where bpm is not null group by bpm order by n desc, bpm limit 40", HR)
def srt_top_values(spark: SparkSession, d: str) -> DataFrame:
    """SRT-03: the 40 most frequent values."""
    return samples(spark, d).filter("bpm is not null").groupBy("bpm").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bpm").limit(40)


@query(
    """, a as (select distinct sid, (ts + off) // 86400 as day from hr), b as (select distinct sid, day from sleep), c as (select distinct sid, day from days)
    select sid, count(*)::bigint as days, sum(h)::bigint as hr_days, sum(s)::bigint as sleep_days, sum(d)::bigint as summary_days, sum(h * s)::bigint as hr_sleep, sum(h * d)::bigint as hr_summary, sum(s * d)::bigint as sleep_summary, sum(h * s * d)::bigint as all_three
    from (select sid, day, max(h) as h, max(s) as s, max(d) as d from (select sid, day, 1 as h, 0 as s, 0 as d from a union all select sid, day, 0, 1, 0 from b union all select sid, day, 0, 0, 1 from c) group by 1, 2) group by sid""",
    HR, SLEEP, DAYS,
)
def set_intersections(spark: SparkSession, d: str) -> DataFrame:
    """SET-01, SET-04: days that signals have in common, from one pass over the union of their days."""
    mark = lambda df, day, i: df.select("sid", day.alias("day"), *[F.lit(int(i == k)).alias(n) for k, n in enumerate("hsd")])
    u = mark(samples(spark, d), F.floor((F.col("ts") + F.col("off")) / 86400), 0).unionByName(mark(sessions(spark, d), F.col("day"), 1)).unionByName(mark(days(spark, d), F.col("day"), 2))
    f = u.groupBy("sid", "day").agg(*[F.max(n).alias(n) for n in "hsd"])
    h, s, x = F.col("h"), F.col("s"), F.col("d")
    return f.groupBy("sid").agg(
        F.count("*").alias("days"), F.sum(h).alias("hr_days"), F.sum(s).alias("sleep_days"), F.sum(x).alias("summary_days"), F.sum(h * s).alias("hr_sleep"), F.sum(h * x).alias("hr_summary"),
        F.sum(s * x).alias("sleep_summary"), F.sum(h * s * x).alias("all_three"),
    )


@query(
    """, ch as (select sid, day from sleep where day >= (select max(day) - 30 from sleep) union select sid, day from days where day >= (select max(day) - 30 from sleep))
    select distinct sid, day + k as day from ch, (values (-1), (0), (1)) v(k)""",
    SLEEP, DAYS,
)
def set_dirty_dates(spark: SparkSession, d: str) -> DataFrame:
    """SET-02: changed days and their neighbours."""
    s, x = sessions(spark, d).select("sid", "day"), days(spark, d).select("sid", "day")
    cut = F.broadcast(s.agg((F.max("day") - 30).alias("cut")))  # one row
    changed = s.union(x).join(cut, F.col("day") >= F.col("cut")).select("sid", "day").distinct()
    return changed.select("sid", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1)).alias("day")).distinct()


@query("select sid, day from days except select sid, day from sleep", DAYS, SLEEP)
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    """SET-03: days with a summary and no sleep."""
    return days(spark, d).select("sid", "day").subtract(sessions(spark, d).select("sid", "day"))


@query("select content, physical_record_id from (select lower(regexp_replace(regexp_replace(content_hash, '^(0x|0X|X''|x'')', ''), '''$', '')) as content, physical_record_id, last_seen_at::timestamptz as seen from physical_records) qualify row_number() over (partition by content order by seen desc, physical_record_id desc) = 1")
def set_dedup(spark: SparkSession, d: str) -> DataFrame:
    """SET-05: one row for each content fingerprint, the last wins."""
    p = table(spark, d, "physical_records", "content_hash", "physical_record_id", "last_seen_at")
    content = F.lower(F.regexp_replace("content_hash", r"^(0[xX]|[xX]')|'$", ""))
    return p.groupBy(content.alias("content")).agg(F.max(F.struct(F.col("last_seen_at").try_cast("timestamp").alias("seen"), "physical_record_id"))["physical_record_id"].alias("physical_record_id"))


# checks and profiles
@query(
    """select source_record_id, w as warning from (select source_record_id, unnest([case when sleep_end_utc <= sleep_start_utc then 'SLEEP_ORDER' end, case when sleep_end_utc - sleep_start_utc > 86400 then 'SLEEP_TOO_LONG' end,
      case when duration_minutes < 0 then 'NEGATIVE_DURATION' end, case when sleep_score < 0 or sleep_score > 100 then 'SCORE_RANGE' end, case when sleep_start_utc is null or sleep_end_utc is null then 'MISSING_BOUND' end,
      case when sleep_end_utc < 946684800 or sleep_end_utc > 1798761600 then 'TIME_RANGE' end]) as w from sleep_sessions) where w is not null group by 1, 2"""
)
def dq_checks(spark: SparkSession, d: str) -> DataFrame:
    """DQ-01, DQ-02: range and order checks of sessions, each warning once a record; the end of time is a parameter."""
    s, t = F.col("sleep_start_utc"), F.col("sleep_end_utc")
    checks = {"SLEEP_ORDER": t <= s, "SLEEP_TOO_LONG": t - s > 86400, "NEGATIVE_DURATION": F.col("duration_minutes") < 0, "SCORE_RANGE": (F.col("sleep_score") < 0) | (F.col("sleep_score") > 100), "MISSING_BOUND": s.isNull() | t.isNull(), "TIME_RANGE": (t < 946684800) | (t > 1798761600)}
    warnings = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return table(spark, d, "sleep_sessions").select("source_record_id", F.explode(warnings).alias("warning")).distinct()


@query("select r.source_db_id, count(*)::bigint as n from physical_records r anti join source_databases s on s.source_db_id = r.source_db_id group by 1")
def dq_foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    """DQ-03: records of unknown sources."""
    return table(spark, d, "physical_records", "source_db_id").join(table(spark, d, "source_databases", "source_db_id"), "source_db_id", "left_anti").groupBy("source_db_id").agg(F.count("*").alias("n"))


@query(
    " union all ".join(
        f"select '{c}' as column_name, count(*)::bigint as n_rows, sum(({c} is null)::int)::bigint as nulls, min({c})::double as lowest, max({c})::double as highest, round(avg({c}), 6) as mean, count(distinct {c})::bigint as n_values from daily_summary"
        for c in ("steps", "step_calories", "total_calories", "activity_duration_minutes", "standing_count", "resting_hr")
    )
)
def prf_table(spark: SparkSession, d: str) -> DataFrame:
    """PRF-01: profile of every numeric column, in one pass over a long form."""
    names = ("steps", "step_calories", "total_calories", "activity_duration_minutes", "standing_count", "resting_hr")
    long = table(spark, d, "daily_summary", *names).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in names])).alias("x")).select("x.*")
    return long.groupBy("column_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col("v").isNull()).alias("nulls"), F.min("v").alias("lowest"), F.max("v").alias("highest"), r6(F.avg("v")).alias("mean"), F.count_distinct("v").alias("n_values"))


@query("select sid, ts, count(*)::bigint as n, count(distinct bpm)::bigint as n_values from hr group by 1, 2 having count(*) > 1", HR)
def prf_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """PRF-02: instants with more than one record of a device."""
    return samples(spark, d).groupBy("sid", "ts").agg(F.count("*").alias("n"), F.count_distinct("bpm").alias("n_values")).filter("n > 1")


@query("select sid, round(100.0::double * count(distinct case when rhr is not null then day end) / (max(day) - min(day) + 1), 6) as coverage_pct, (max(day) - min(day) + 1)::bigint as calendar_days from days group by sid", DAYS)
def prf_coverage(spark: SparkSession, d: str) -> DataFrame:
    """PRF-05: usable days as a share of calendar days."""
    span = F.max("day") - F.min("day") + 1
    return days(spark, d).groupBy("sid").agg(r6(F.lit(100.0) * F.count_distinct(F.when(F.col("rhr").isNotNull(), F.col("day"))) / span).alias("coverage_pct"), span.alias("calendar_days"))


@query(
    """, e as (select sid, day, rhr, count(rhr) over w as n, stddev_samp(rhr) over w as sd from days window w as (partition by sid order by day rows between unbounded preceding and 1 preceding))
    select sid, sum((rhr is not null and n >= 7)::int)::bigint as warm, sum((rhr is not null and n >= 7 and round(sd, 9) >= 1)::int)::bigint as eligible from e group by sid""",
    DAYS,
)
def prf_eligibility(spark: SparkSession, d: str) -> DataFrame:
    """WIN-12, PRF-06: days with enough earlier observations, and enough spread in them."""
    w = Window.partitionBy("sid").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    e = days(spark, d).select("sid", "rhr", F.count("rhr").over(w).alias("n"), F.stddev_samp("rhr").over(w).alias("sd"))
    warm = F.col("rhr").isNotNull() & (F.col("n") >= 7)
    return e.groupBy("sid").agg(F.count_if(warm).alias("warm"), F.count_if(warm & (F.round("sd", 9) >= 1)).alias("eligible"))


DIGESTED = ("sid", "source_db_id", "local_date", "steps", "step_calories", "total_calories", "activity_duration_minutes", "standing_count", "resting_hr")


@query(
    "select count(*)::bigint as n, sum(('0x' || substr(h, 1, 15))::hugeint)::varchar as high, sum(('0x' || substr(h, 16, 15))::hugeint)::varchar as low from (select sha256(concat_ws('|', "
    + ", ".join(f"coalesce({c if c not in ('step_calories', 'total_calories', 'activity_duration_minutes', 'resting_hr') else f'round({c} * 1000)::bigint'}::varchar, '~')" for c in DIGESTED)
    + ")) as h from daily_summary)"
)
def digest_table(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20: digest of a table that doesn't depend on the order of its rows: 120 bits of each row's hash, summed in two halves.

    Of all columns but ``updated_at``, the one that a repeated import changes; numbers with a fraction in thousandths.
    """
    t = table(spark, d, "daily_summary", *DIGESTED)
    text = lambda c: F.coalesce((F.round(F.col(c) * 1000).cast("bigint") if t.schema[c].dataType.simpleString() == "double" else F.col(c)).cast("string"), F.lit("~"))
    h = F.sha2(F.concat_ws("|", *map(text, DIGESTED)), 256)
    half = lambda at: F.sum(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return t.agg(F.count("*").alias("n"), half(1).alias("high"), half(16).alias("low"))


@query("select (max(ts) - 172800) // 86400 as cutoff_day, count(distinct sid)::bigint as devices, count(*)::bigint as n, max(ts) as last_ts from hr", HR)
def sta_status(spark: SparkSession, d: str) -> DataFrame:
    """STA-01, STA-04: checkpoint of the store."""
    return samples(spark, d).agg(F.floor((F.max("ts") - 172800) / 86400).alias("cutoff_day"), F.count_distinct("sid").alias("devices"), F.count("*").alias("n"), F.max("ts").alias("last_ts"))
