"""Reconciliation of the physical records."""

from __future__ import annotations

from ..operators import reconcile as r
from .common import DataFrame, F, SparkSession, registry, table

QUERIES, SQL, query = registry()

SEEN = """seen as (
  select p.physical_record_id, p.last_seen_generation, g.scanned_at as scanned, logical_record_id, source_db_id, source_timestamp, local_date, value_json, status, lower(regexp_replace(regexp_replace(trim(content_hash), '^(0[xX]|[xX]'')', ''), '''$', '')) as content
  from physical_records p join source_generations g on g.generation_id = p.last_seen_generation
  qualify row_number() over (partition by p.physical_record_id, p.last_seen_generation order by last_seen_at::timestamptz desc, logical_record_id desc, source_db_id desc, source_timestamp desc nulls last, local_date desc nulls last, value_json desc nulls last, status desc, content desc) = 1
)"""
CURRENT = "cur as (select * from {src} qualify row_number() over (partition by physical_record_id order by scanned desc) = 1)"
PICK = """pick as (
  select logical_record_id, active_copies, contents, meanings, case when not (meanings > 1 and {exclude}) then best end as selected_id,
    case when meanings > 1 and ({exclude} or best is null) then 'UNRESOLVED_EXCLUDED' when meanings > 1 then 'UNRESOLVED_SELECTED_FOR_COMPATIBILITY' when contents > 1 then 'EQUIVALENT_PHYSIOLOGY_METADATA_DIFF' when active_copies > 1 then 'DUPLICATE_EQUAL' else 'NONE' end as conflict
  from (select logical_record_id, sum((status = 'ACTIVE')::int)::bigint as active_copies, count(distinct content) filter (where status = 'ACTIVE') as contents,
      count(distinct coalesce(value_json, '~') || '|' || coalesce(source_timestamp::varchar, '~') || '|' || coalesce(local_date, '~')) filter (where status = 'ACTIVE') as meanings,
      arg_min(physical_record_id, (case when ends_with(source_key, '{first}') then 0 when ends_with(source_key, '{second}') then 1 else 2 end, source_key, physical_record_id)) filter (where status = 'ACTIVE') as best
    from cur left join source_databases using (source_db_id) group by 1)
)"""
RU = {"first": ":region:ru", "second": ":region:cn"}
NOW = (SEEN, CURRENT.format(src="seen"))


def seen(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "physical_records", "physical_record_id", "last_seen_generation", "last_seen_at", "logical_record_id", "source_db_id", "source_timestamp", "local_date", "value_json", "status", "content_hash")
    return r.one_per_generation(p.withColumn("content", r.content_of(F.col("content_hash"))), table(spark, d, "source_generations"))


@query("select logical_record_id, selected_id, active_copies, contents, meanings from pick", *NOW, PICK.format(exclude="false", **RU))
def rec_select(spark: SparkSession, d: str) -> DataFrame:
    """REC-04, AGG-17, JN-09: the copy selected for each record."""
    s = r.select_canonical(r.current(seen(spark, d)), table(spark, d, "source_databases"), r.POLICIES["ru_compat"])
    return s.select("logical_record_id", "selected_id", "active_copies", "contents", "meanings")


@query("select conflict, count(*)::bigint as n, sum((selected_id is not null)::int)::bigint as selected from pick group by conflict", *NOW, PICK.format(exclude="true", **RU))
def rec_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """REC-05: kinds of conflicts where unresolved records are excluded."""
    s = r.select_canonical(r.current(seen(spark, d)), table(spark, d, "source_databases"), r.POLICIES["unresolved_exclude"])
    return s.groupBy("conflict").agg(F.count("*").alias("n"), F.count("selected_id").alias("selected"))


@query(
    """select cur.logical_record_id, physical_record_id, case when physical_record_id = selected_id then 'PRIMARY' when status = 'ACTIVE' and meanings > 1 then 'CONFLICT_ALTERNATIVE' when status = 'ACTIVE' and contents > 1 then 'DUPLICATE_EQUIVALENT'
      when status = 'ACTIVE' then 'DUPLICATE_EQUAL' when status = 'TOMBSTONE' then 'TOMBSTONE_SOURCE' else 'SOURCE_MISSING' end as role from cur join pick on pick.logical_record_id = cur.logical_record_id""",
    *NOW, PICK.format(exclude="false", first=":region:cn", second=":region:ru"),
)
def rec_roles(spark: SparkSession, d: str) -> DataFrame:
    """REC-06: the role of each copy, with the other region preferred."""
    copies = r.current(seen(spark, d))
    return r.roles(copies, r.select_canonical(copies, table(spark, d, "source_databases"), r.POLICIES["cn_review"]))


@query(
    """, ch as (select *, content is distinct from lag(content) over w or status is distinct from lag(status) over w or lag(scanned) over w is null as changed from seen window w as (partition by physical_record_id order by scanned))
    select physical_record_id, content, status, epoch_us(active_from::timestamptz) as active_from, epoch_us(active_to::timestamptz) as active_to from (select physical_record_id, content, status, scanned as active_from, lead(scanned) over (partition by physical_record_id order by scanned) as active_to from ch where changed)""",
    SEEN,
)
def rec_scd2(spark: SparkSession, d: str) -> DataFrame:
    """REC-01, JN-14: history of each copy, a version for each change of content or status."""
    return r.versions(seen(spark, d)).withColumns({c: F.unix_micros(c) for c in ("active_from", "active_to")})


@query(
    """, l as (select source_db_id, max(scanned) as ls from seen group by 1)
    select physical_record_id, cur.source_db_id, status as last_status from cur join l on l.source_db_id = cur.source_db_id where scanned < ls and status <> 'MISSING'""",
    *NOW,
)
def rec_missing(spark: SparkSession, d: str) -> DataFrame:
    """REC-02, JN-11: copies absent from the last snapshot of their source."""
    return r.missing(seen(spark, d))


CUT = "2025-06-16 12:00:00"


@query(
    "with " + SEEN + ", " + ", ".join(
        f"cur_{k} as (select * from seen where {cond} qualify row_number() over (partition by physical_record_id order by scanned desc) = 1), "
        + PICK.format(exclude="false", **RU).replace("pick as", f"pick_{k} as").replace("from cur ", f"from cur_{k} ")
        + f", sel_{k} as (select p.*, c.content, c.local_date from pick_{k} p left join cur_{k} c on c.physical_record_id = p.selected_id)"
        for k, cond in (("a", f"scanned < timestamptz '{CUT}+00'"), ("b", "true"))
    ) + """ select logical_record_id, change, old_date, new_date from (
      select coalesce(b.logical_record_id, a.logical_record_id) as logical_record_id, a.local_date as old_date, b.local_date as new_date,
        case when a.selected_id is null and b.selected_id is not null then 'INSERT' when a.selected_id is not null and b.selected_id is null then 'DELETE' when a.selected_id is null then null
          when a.content is distinct from b.content or a.local_date is distinct from b.local_date then 'UPDATE' when a.conflict is distinct from b.conflict then 'CONFLICT_CHANGE' end as change
      from sel_a a full outer join sel_b b on a.logical_record_id = b.logical_record_id) where change is not null"""
)
def rec_changelog(spark: SparkSession, d: str) -> DataFrame:
    """REC-07, JN-10, JN-08: what the scans after a given instant changed in the selection."""
    s, sources = seen(spark, d), table(spark, d, "source_databases")

    def selected(rows: DataFrame) -> DataFrame:
        copies = r.current(rows)
        picked = r.select_canonical(copies, sources, r.POLICIES["ru_compat"]).select("logical_record_id", "selected_id", "conflict")
        return picked.join(copies.select(F.col("physical_record_id").alias("selected_id"), "content", "local_date"), "selected_id", "left")

    return r.change_log(selected(s.filter(F.col("scanned") < F.lit(CUT).cast("timestamp"))), selected(s))
