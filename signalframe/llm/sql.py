"""DuckDB SQL of the queries that SQL can express on whole tables."""

SQL = {
    "p3_found": """
with state as (
  select *, last_seen_at::timestamptz as seen from physical_records
  qualify row_number() over (partition by physical_record_id order by last_seen_at::timestamptz desc, status desc) = 1
), counted as (
  select s.*, d.trust_level, count(*) over (partition by logical_record_id) as copies
  from state s left join source_databases d on d.source_db_id = s.source_db_id
), vals as (
  select logical_record_id, physical_record_id, trust_level, seen, status, copies, f.field_name, f.v from counted,
  lateral (values ('source_timestamp', source_timestamp::varchar), ('local_date', local_date),
    ('bpm', case when json_valid(value_json) then json_extract_string(value_json, '$.bpm') end),
    ('zone_name', case when json_valid(row_json) then json_extract_string(row_json, '$.zone_name') end)) as f(field_name, v)
)
select logical_record_id, field_name, physical_record_id from vals
where copies > 1 and status = 'ACTIVE' and v is not null
  and lower(trim(v)) not in ('', '-', '--', '?', 'n/a', 'na', 'nan', 'nil', 'none', 'null', 'tbd', 'undefined', 'unknown')
  and not regexp_full_match(trim(v), '[+-]?[0:/.T -]*')
qualify row_number() over (partition by logical_record_id, field_name order by trust_level desc nulls last, seen desc, physical_record_id) = 1
""",
}
