"""Keeping, merging and describing results, over the physical records, sessions and days."""

from __future__ import annotations

from ..functions import identity
from ..operators import reconcile as r
from ..operators.joins import as_of
from ..operators.statistics import nearest_ranks
from ..operators.windows import with_previous
from ..sources import databases
from . import normalize as n
from . import runs
from . import store as s
from .common import DAYS, HR, SLEEP, DataFrame, F, SparkSession, days, registry, samples, sessions, table
from .export import NIGHT_CTES, from_readings, from_sessions
from .reconcile_queries import CUT, SEEN, seen

QUERIES, SQL, query = registry()

BEFORE = f"seen_a as (select * from seen where scanned < timestamptz '{CUT}+00'), cur_a as (select * from seen_a qualify row_number() over (partition by physical_record_id order by scanned desc) = 1)"
SINCE = f"seen_b as (select * from seen where scanned >= timestamptz '{CUT}+00'), cur_b as (select * from seen_b qualify row_number() over (partition by physical_record_id order by scanned desc) = 1)"


def _states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The last state of each copy in the scans before an instant, and in those since."""
    x = seen(spark, d)
    early = F.col("scanned") < F.lit(CUT).cast("timestamp")
    return tuple(r.current(x.filter(c)).select("physical_record_id", "logical_record_id", "content", "status") for c in (early, ~early))


# merges
@query("select physical_record_id, logical_record_id, content, status from (select * from seen qualify row_number() over (partition by physical_record_id order by scanned desc) = 1)", SEEN)
def snk_upsert(spark: SparkSession, d: str) -> DataFrame:
    """SNK-01: later states merged into earlier ones by key: the states of all scans together."""
    old, new = _states(spark, d)
    return s.upsert(old, new, ["physical_record_id"])


@query("select sid, day, steps, rhr from days", DAYS)
def snk_partial_upsert(spark: SparkSession, d: str) -> DataFrame:
    """SNK-02: later daily values merged into earlier ones column by column; a null erases nothing."""
    from ..operators.regular import daily_values

    daily = table(spark, d, "daily_summary", "sid", "local_date", "updated_at", "steps", "resting_hr")
    values = lambda x: daily_values(x, "sid", "local_date", "updated_at", {"steps": F.when(F.col("steps") >= 0, F.col("steps")), "rhr": F.when(F.col("resting_hr") > 0, F.col("resting_hr"))}).withColumnRenamed("e", "sid")
    early = F.col("updated_at") < F.lit("2025-08-01").cast("timestamp")
    return s.partial_upsert(values(daily.filter(early)), values(daily.filter(~early)), ["sid", "day"])


@query("select source_record_id || ':sleep:night' as source_record_id, i as stage_index, code as raw_state from xt join xs using (source_record_id) where not coalesce(duration_minutes < 300, false) or i < 3", *NIGHT_CTES)
def snk_replace_children(spark: SparkSession, d: str) -> DataFrame:
    """SNK-03: the stages of short sessions replaced by their first three; those of others stay."""
    raw = from_sessions(spark, d, "sleep")
    stages = n.sleep_stages(raw).select("source_record_id", "stage_index", "raw_state")
    short = n.sleep_sessions(raw).filter("duration_minutes < 300").select("source_record_id")
    new = stages.join(short, "source_record_id", "left_semi").filter("stage_index < 3")
    return s.replace_children(stages, new, short, "source_record_id")


REVISIONS = f"""r1 as (select distinct physical_record_id, content, status from seen where scanned < timestamptz '{CUT}+00'), r2 as (
  select distinct physical_record_id, content, status from seen where scanned >= timestamptz '{CUT}+00' and (physical_record_id, content, status) not in (select (physical_record_id, content, status) from r1)
), revs as (select *, 1 as revision from r1 union all select *, 2 from r2)"""


def _revisions(spark: SparkSession, d: str) -> DataFrame:
    x, early = seen(spark, d), F.col("scanned") < F.lit(CUT).cast("timestamp")
    none = spark.createDataFrame([], "physical_record_id string, content string, status string, revision int")
    columns = ["physical_record_id", "content", "status"]
    first = s.add_revisions(none, x.filter(early).select(*columns), columns)
    return s.add_revisions(first, x.filter(~early).select(*columns), columns)


@query("select * from revs", SEEN, REVISIONS)
def snk_revisions(spark: SparkSession, d: str) -> DataFrame:
    """SNK-04: drafts appended as revisions unless they are there already; none is ever changed."""
    return _revisions(spark, d)


@query("select * from revs qualify row_number() over (partition by physical_record_id order by revision desc, content desc, status desc) = 1", SEEN, REVISIONS)
def join_active(spark: SparkSession, d: str) -> DataFrame:
    """JN-08: the revision that each key points to."""
    return s.active(_revisions(spark, d), ["physical_record_id"], "revision", "content", "status")


@query("select sid, day, 'rhr' as metric from days where rhr is not null union all select sid, day, 'steps' from days where steps is not null and day < 20270", DAYS)
def snk_retract(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05, JN-12: pointers of days computed again, without what they no longer give."""
    x = days(spark, d)
    pointers = lambda *names: x.select("sid", "day", F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in names]))).alias("metric"))
    return s.retract(pointers("rhr", "steps"), pointers("rhr"), x.filter("day >= 20270").select("sid", "day"), ["sid", "day", "metric"], ["sid", "day"])


@query("select b.physical_record_id, case when a.physical_record_id is null then 'new' when a.content = b.content then 'unchanged' else 'updated' end as change from cur_b b left join cur_a a using (physical_record_id)", SEEN, BEFORE, SINCE)
def join_classify(spark: SparkSession, d: str) -> DataFrame:
    """JN-14, CLN-07, SRC-20: later records as new, updated or unchanged by their content."""
    old, new = _states(spark, d)
    return s.classify(new, old, ["physical_record_id"], "content").select("physical_record_id", "change")


@query("select b.physical_record_id, b.content, b.status, case when a.content = b.content and a.status = b.status then 'first' else 'second' end as imported_at from cur_b b left join cur_a a using (physical_record_id)", SEEN, BEFORE, SINCE)
def rec_mirror(spark: SparkSession, d: str) -> DataFrame:
    """REC-08: a rebuilt table keeps the import time of rows that stayed the same."""
    old, new = _states(spark, d)
    kept = old.withColumn("imported_at", F.lit("first"))
    return r.mirror(new, kept, "physical_record_id", ["content", "status"], "imported_at", F.lit("second")).select("physical_record_id", "content", "status", "imported_at")


@query("select distinct b.physical_record_id, 'value' as column_name, sha256(b.content) as sha256 from cur_b b left join cur_a a using (physical_record_id) where a.content is distinct from b.content or a.status is distinct from b.status union select physical_record_id, 'value', sha256(content) from cur_a", SEEN, BEFORE, SINCE)
def rec_blob_archive(spark: SparkSession, d: str) -> DataFrame:
    """REC-03: bytes of changed copies added to an archive that has those of before, each content once."""
    old, new = _states(spark, d)
    blobs = lambda x: x.select("physical_record_id", F.lit("value").alias("column_name"), F.sha2("content", 256).alias("sha256"))
    return r.archived_blobs(blobs(new), r.state_changes(new, old), blobs(old))


@query(
    """select physical_record_id, content, status, case when same is not null then 'before' else 'after' end as active_from, case when gone then 'after' end as active_to from (
      select physical_record_id, content, status, 1 as same, exists (select 1 from cur_b b where b.physical_record_id = a.physical_record_id and (b.content <> a.content or b.status <> a.status)) as gone from cur_a a
      union all select b.physical_record_id, b.content, b.status, null, false from cur_b b left join cur_a a using (physical_record_id) where a.content is distinct from b.content or a.status is distinct from b.status)""",
    SEEN, BEFORE, SINCE,
)
def rec_extend_history(spark: SparkSession, d: str) -> DataFrame:
    """REC-01: a history kept from run to run: versions of changed copies are closed and opened, others stay."""
    old, new = _states(spark, d)
    none = spark.createDataFrame([], "physical_record_id string, content string, status string, active_from string, active_to string")
    first = r.extend_history(none, r.state_changes(old, old.limit(0)), "before")
    return r.extend_history(first, r.state_changes(new, old), "after")


# identity
PLAIN = ("local_date", "physical_record_id", "source_db_id", "source_deleted", "source_timestamp", "status")
_TEXTS = ("local_date", "physical_record_id", "status")


@query("select physical_record_id, last_seen_generation, sha256(" + " || ".join(f"'{c}' || chr(0) || coalesce({'to_json(' + c + ')::varchar' if c in _TEXTS else c + '::varchar'}, 'null') || chr(0)" for c in PLAIN) + ") as content, count(*)::bigint as n from physical_records group by all")
def cln_content_hash(spark: SparkSession, d: str) -> DataFrame:
    """CLN-07: hash over all columns of a record, sorted by name."""
    t = table(spark, d, "physical_records", *PLAIN, "last_seen_generation")
    return t.groupBy("physical_record_id", "last_seen_generation", identity.content_hash(t.select(*PLAIN).schema).alias("content")).agg(F.count("*").alias("n"))


@query("""select physical_record_id, last_seen_generation, '{"physical_record_id":' || to_json(physical_record_id)::varchar || ',"source_db_id":' || source_db_id || ',"source_table":' || to_json(source_table)::varchar || '}' as scalars, count(*)::bigint as n, count(value_json)::bigint as payloads from physical_records group by all""")
def cln_record_split(spark: SparkSession, d: str) -> DataFrame:
    """CLN-05: what of a record is neither envelope nor payload, as canonical JSON (bytes and payloads are tested on fixtures)."""
    t = table(spark, d, "physical_records", "physical_record_id", "last_seen_generation", "source_db_id", "source_table", F.col("source_timestamp").alias("time"), F.col("value_json").alias("value"))
    parts = identity.split_record(t.drop("last_seen_generation").schema)
    x = t.select("physical_record_id", "last_seen_generation", parts["scalars"].alias("scalars"), parts["value_json"].alias("v"))
    return x.groupBy("physical_record_id", "last_seen_generation", "scalars").agg(F.count("*").alias("n"), F.count("v").alias("payloads"))


@query("""select generation_id, sha256('scans|{"conflict_policy_version":' || to_json(conflict_policy_version)::varchar || ',"generation_id":' || to_json(generation_id)::varchar || ',"source_database_count":' || source_database_count || '}') as logical from source_generations""")
def cln_identity_without_key(spark: SparkSession, d: str) -> DataFrame:
    """CLN-06: identity of rows without a primary key and without the usual columns: all columns that aren't bytes."""
    t = table(spark, d, "source_generations", "generation_id", "source_database_count", "conflict_policy_version")
    return t.select("generation_id", identity.logical_id(F.lit("scans"), {c: F.col(c) for c in identity.key_columns(t.schema)}).alias("logical"))


# sources
CATALOGUED = ("heart_rate", "sleep_sessions", "daily_summary", "physical_records", "source_databases", "source_generations", "orders")
_LIST = ", ".join(f"'{t}'" for t in CATALOGUED)
_KNOWN = ", ".join(f"'{t}'" for t in databases.KNOWN_TABLES)


@query(
    f"""with c as (select table_name, column_name, ordinal_position - 1 as position from information_schema.columns where table_name in ({_LIST})),
    b as (select table_name, bool_or(regexp_matches(lower(column_name), '{"|".join(databases.COLUMN_PARTS)}')) as by_column from c group by 1)
    select table_name, column_name, position, table_name in ({_KNOWN}) or regexp_matches(lower(table_name), '{"|".join(databases.TABLE_PARTS)}') or by_column as relevant, (select count(distinct table_name) from c where table_name in ('heart_rate', 'sleep', 'steps', 'spo2', 'stress')) >= 3 as health_store from c join b using (table_name)"""
)
def src_catalog(spark: SparkSession, d: str) -> DataFrame:
    """SRC-06, SRC-07, SRC-08: columns of tables, whether a table is one of health data, and whether the store is."""
    rows = [(d, t, f.name, i) for t in CATALOGUED for i, f in enumerate(table(spark, d, t).schema.fields)]
    return databases.catalog(spark.createDataFrame(rows, "path string, table_name string, column_name string, position int")).drop("path")


@query("select source_db_id, max(case when json_valid(value_json) then (json_extract_string(value_json, '$.bpm') is not null)::int end)::bigint as gives_rate from physical_records group by 1")
def join_json_probe(spark: SparkSession, d: str) -> DataFrame:
    """JN-13: whether any record of a source has a field, in one pass with partial results."""
    found = F.try_variant_get(F.try_parse_json("value_json"), "$.bpm", "string").isNotNull()
    valid = F.try_parse_json("value_json").isNotNull()
    return table(spark, d, "physical_records", "source_db_id", "value_json").groupBy("source_db_id").agg(F.max(F.when(valid, found.cast("bigint"))).alias("gives_rate"))


@query(
    """, r as (select sid, source_record_id, ts, 'heart_rate' as kind, bpm::double as value, case when bpm between 25 and 240 then 'VALID' else 'INVALID' end as quality from hr where bpm is not null
      union all select sid, source_record_id, ts, 'spo2', 85 + ts % 17, case when 85 + ts % 17 > 100 then 'INVALID' else 'VALID' end from hr union all select sid, source_record_id, ts, 'stress', ts % 100, null from hr)
    select kind, quality, count(*)::bigint as n, min(ts) as first_ts, max(ts) as last_ts, sum(value) as total from r where ts >= 1748736000 and ts < 1751328000 group by 1, 2""",
    HR,
)
def src_kinds(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10, SRC-18, CLN-12, CLN-13: half-open ranges of three kinds of signals through the source protocol, with their quality."""
    from ..sources.adapter import CAPABILITIES, TableSource

    at = lambda k, v, q: lambda: n.samples(from_readings(spark, d, k), k).select("sid", "source_record_id", F.col("timestamp_utc").alias("ts"), F.lit(k).alias("kind"), F.col(v).cast("double").alias("value"), q.alias("quality"))
    kinds = {"heart_rate": at("heart_rate", "bpm", F.when(F.col("bpm").between(25, 240), "VALID").otherwise("INVALID")), "spo2": at("spo2", "value", n.saturation_quality(F.col("value"))), "stress": at("stress", "value", F.lit(None).cast("string"))}
    source = TableSource(kinds, spark.createDataFrame(CAPABILITIES, "kind string, supported boolean, origin string, resolution_s int"), "g")
    x = source.read("heart_rate", 1748736000, 1751328000).union(source.read("spo2", 1748736000, 1751328000)).union(source.read("stress", 1748736000, 1751328000))
    return x.groupBy("kind", "quality").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("value").alias("total"))


# profiles
@query(
    """, x as (select source_record_id, 'heart_rate_range' as warning from hr where bpm < 25 or bpm > 240 union select source_record_id || ':spo2:sample', 'spo2_range' from hr where 85 + ts % 17 > 100 union select source_record_id, 'timestamp_range' from hr where ts < 1738368000 or ts > 1764547200
      union select source_record_id || ':sleep:night', 'timestamp_range' from sleep where t < 1738368000 or t > 1764547200) select * from x""",
    HR, SLEEP,
)
def dq_ranges(spark: SparkSession, d: str) -> DataFrame:
    """DQ-02: values and times outside their limits, in readings, saturations and sessions; the limits of time are parameters."""
    hr, spo2, night = samples(spark, d), n.samples(from_readings(spark, d, "spo2"), "spo2"), n.sleep_sessions(from_sessions(spark, d, "sleep"))
    first, last = 1738368000, 1764547200
    found = [runs.range_warnings(hr, "bpm", 25, 240, "heart_rate_range"), runs.range_warnings(spo2, "value", 50, 100, "spo2_range"), runs.range_warnings(hr, "ts", first, last, "timestamp_range"), runs.range_warnings(night, "sleep_end_utc", first, last, "timestamp_range")]
    return found[0].union(found[1]).union(found[2]).union(found[3]).distinct()


@query("select 'kind' as column_name, kind as value, count(*)::bigint as n from heart_rate group by all union all select 'zone_name', zone_name, count(*) from heart_rate group by all union all select 'local_date', null, count(distinct local_date) from heart_rate")
def prf_categories(spark: SparkSession, d: str) -> DataFrame:
    """PRF-01: how often each value of a categorical column occurs, and on how many days there is anything; one pass, partial counts."""
    t = table(spark, d, "heart_rate", "kind", "zone_name", "local_date")
    long = t.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in t.columns])).alias("x")).select("x.*")
    counted = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    per_day = counted.filter("column_name = 'local_date' and value is not null").groupBy("column_name").agg(F.count("*").alias("n")).select("column_name", F.lit(None).cast("string").alias("value"), "n")
    return counted.filter("column_name <> 'local_date'").unionByName(per_day)


PS = (10, 25, 50, 75, 90, 95, 99)


@query(
    """, main as (select sid, s, max(t) as t from sleep where is_nap_inferred = 0 group by 1, 2),
    st as (select h.sid, h.ts, h.off, coalesce(h.ts < m.t, false) as asleep from hr h asof left join main m on h.sid = m.sid and h.ts >= m.s),
    g as (select *, ts - lag(ts) over (partition by sid order by ts) as gap, lag(asleep) over (partition by sid order by ts) as was from st),
    b as (select case when ((ts + off) // 3600) % 24 < 9 or ((ts + off) // 3600) % 24 >= 22 then 'clock_night' else 'clock_day' end as bucket, gap from g where gap <= 21600 union all select case when asleep then 'within_sleep' else 'outside_sleep' end, gap from g where gap <= 21600 and asleep = was),
    r as (select bucket, gap, row_number() over (partition by bucket order by gap) - 1 as i, count(*) over (partition by bucket) as n from b), p as (select unnest([10, 25, 50, 75, 90, 95, 99]) as p)
    select bucket, n, p::int as p, gap as value from r, p where i = round_even((n - 1) * p / 100.0, 0)::bigint""",
    HR, SLEEP,
)
def prf_intervals(spark: SparkSession, d: str) -> DataFrame:
    """PRF-02, JN-03, AGG-16: sampling intervals by clock night and day, and within and outside the main sleep."""
    main = sessions(spark, d).filter("is_nap_inferred = 0").select("sid", "s", "t")
    x = with_previous(samples(spark, d).select("sid", "ts", "off"), ["sid"], "ts").withColumn("gap", F.col("ts") - F.col("previous")).filter("gap <= 21600").drop("__shard")
    now = as_of(x, main, ["sid"], "ts", "s", ["t"]).withColumn("asleep", F.coalesce(F.col("ts") < F.col("t"), F.lit(False))).drop("t")
    both = as_of(now, main, ["sid"], "previous", "s", ["t"]).withColumn("was", F.coalesce(F.col("previous") < F.col("t"), F.lit(False)))
    hour = F.pmod(F.floor((F.col("ts") + F.col("off")) / 3600), F.lit(24))
    clock = F.when((hour < 9) | (hour >= 22), "clock_night").otherwise("clock_day")
    sleep = F.when(F.col("asleep") == F.col("was"), F.when(F.col("asleep"), "within_sleep").otherwise("outside_sleep"))
    return nearest_ranks(both.select(F.explode(F.array_compact(F.array(clock, sleep))).alias("bucket"), "gap"), ["bucket"], "gap", PS)


@query(
    """, b as (select 'duration_minus_clock' as delta, round(duration_minutes - (t - s) / 60.0, 3)::double as v from xs where duration_minutes is not null union all select 'stages_minus_clock', round(total - span, 3)::double from xg
      union all select 'reported_minus_asleep', round(duration_minutes - (deep + light + rem), 3)::double from xg join xs using (source_record_id) where duration_minutes is not null),
    r as (select delta, v, row_number() over (partition by delta order by v) - 1 as i, count(*) over (partition by delta) as n from b), p as (select unnest([10, 25, 50, 75, 90, 95, 99]) as p)
    select delta, n, p::int as p, v as value from r, p where i = round_even((n - 1) * p / 100.0, 0)::bigint""",
    *NIGHT_CTES,
)
def prf_sleep_deltas(spark: SparkSession, d: str) -> DataFrame:
    """PRF-03: how far reported durations, stages and clocks of sessions are apart."""
    raw = from_sessions(spark, d, "sleep")
    x = n.sleep_sessions(raw).select("source_record_id", "duration_minutes", ((F.col("sleep_end_utc") - F.col("sleep_start_utc")) / 60.0).alias("span"))
    g = n.sleep_stages(raw).withColumn("secs", F.col("end_timestamp_utc") - F.col("start_timestamp_utc")).groupBy("source_record_id")
    g = g.agg((F.sum("secs") / 60.0).alias("total"), *[(F.sum(F.when(F.col("stage") == k, F.col("secs")).otherwise(0)) / 60.0).alias(k) for k in ("deep", "light", "rem")])
    j = x.join(g, "source_record_id", "left")
    deltas = {"duration_minus_clock": F.col("duration_minutes") - F.col("span"), "stages_minus_clock": F.col("total") - F.col("span"), "reported_minus_asleep": F.col("duration_minutes") - (F.col("deep") + F.col("light") + F.col("rem"))}
    long = j.select(F.explode(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("delta"), (F.round(v, 3) + 0.0).alias("v"))) for k, v in deltas.items()]))).alias("x")).select("x.*")
    return nearest_ranks(long, ["delta"], "v", PS)


#: Combinations of signals whose common days are counted.
COMBINATIONS = {
    "rhr_sleep": ("rhr", "sleep"), "rhr_sleep_score": ("rhr", "sleep", "score"), "rhr_sleep_spo2": ("rhr", "sleep", "spo2"), "rhr_respiration_sleep": ("rhr", "respiration", "sleep"), "rhr_sleep_steps": ("rhr", "sleep", "steps"), "stress_sleep": ("stress", "sleep"),
    "steps_sleep": ("steps", "sleep"), "hr_rhr_steps": ("hr", "rhr", "steps"), "hr_rhr_sleep": ("hr", "rhr", "sleep"), "spo2_rhr": ("spo2", "rhr"), "workout_rhr": ("workout", "rhr"),
}
SIGNALS = ("hr", "rhr", "steps", "sleep", "score", "respiration", "spo2", "stress", "workout")
BIT = {k: 1 << i for i, k in enumerate(SIGNALS)}


@query(
    f""", m as (select sid, (ts + off) // 86400 as day, {BIT["hr"] | BIT["stress"]} + case when 85 + ts % 17 <= 100 then {BIT["spo2"]} else 0 end as bits from hr
      union all select sid, day, case when rhr is not null then {BIT["rhr"]} else 0 end + case when steps is not null then {BIT["steps"]} else 0 end from days
      union all select sid, day, {BIT["sleep"]} + case when sleep_score is not null then {BIT["score"]} else 0 end + case when avg_respiratory_rate > 0 then {BIT["respiration"]} else 0 end from sleep where is_nap_inferred = 0
      union all select sid, (s - 7200 + off) // 86400, {BIT["workout"]} from sleep),
    f as (select sid, day, bit_or(bits) as bits from m group by 1, 2)
    select combination, count(*)::bigint as days, count(distinct sid)::bigint as devices, min(day) as first_day, max(day) as last_day from f join (values """
    + ", ".join(f"('{k}', {sum(BIT[x] for x in v)})" for k, v in COMBINATIONS.items()) + ") c(combination, mask) on (bits & mask) = mask group by 1",
    HR, DAYS, SLEEP,
)
def set_combinations(spark: SparkSession, d: str) -> DataFrame:
    """SET-01: days that signals have in common, in all eleven combinations, from one pass over the union of their days."""
    bit = lambda k, there: F.when(there, BIT[k]).otherwise(0)
    marked = lambda x, day, bits: x.select("sid", day.alias("day"), bits.alias("bits"))
    hr, day, night = samples(spark, d), days(spark, d), sessions(spark, d)
    o2 = 85 + F.col("ts") % 17
    m = marked(hr, F.floor((F.col("ts") + F.col("off")) / 86400), F.lit(BIT["hr"] | BIT["stress"]) + bit("spo2", o2 <= 100)).unionByName(marked(day, F.col("day"), bit("rhr", F.col("rhr").isNotNull()) + bit("steps", F.col("steps").isNotNull())))
    main = night.filter("is_nap_inferred = 0")
    m = m.unionByName(marked(main, F.col("day"), F.lit(BIT["sleep"]) + bit("score", F.col("sleep_score").isNotNull()) + bit("respiration", F.col("avg_respiratory_rate") > 0)))
    m = m.unionByName(marked(night, F.floor((F.col("s") - 7200 + F.col("off")) / 86400), F.lit(BIT["workout"])))
    f = m.groupBy("sid", "day").agg(F.bit_or("bits").alias("bits"))
    masks = F.array(*[F.when(F.col("bits").bitwiseAND(mask) == mask, F.lit(k)) for k, v in COMBINATIONS.items() for mask in [sum(BIT[x] for x in v)]])
    return f.select("sid", "day", F.explode(F.array_compact(masks)).alias("combination")).groupBy("combination").agg(F.count("*").alias("days"), F.count_distinct("sid").alias("devices"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
