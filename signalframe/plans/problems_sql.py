"""DuckDB SQL of the pN_ queries that SQL can express on whole tables."""

INST = r"""
raw_text as (
  select *, trim(timestamp_utc) as x, regexp_replace(trim(timestamp_utc), '\[.*\]$', '') as u from heart_rate
), cut_text as (
  select *, case when regexp_matches(u, '[T:]\d.*(Z|[+-]\d{2}:?\d{2})$') then regexp_extract(u, '(Z|[+-]\d{2}:?\d{2})$', 1) else '' end as z from raw_text
), wall_parts as (
  select *, trim(left(u, length(u) - length(z))) as b from cut_text
), wall_times as (
  select *,
    try_strptime(b, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M', '%Y%m%dT%H%M%S', '%d.%m.%Y %H:%M:%S', '%a, %d %b %Y %H:%M:%S']) as plain_wall,
    try_strptime(b, ['%d/%m/%Y %H:%M:%S', '%d/%m/%Y %I:%M:%S %p']) as dm, try_strptime(b, ['%m/%d/%Y %H:%M:%S', '%m/%d/%Y %I:%M:%S %p']) as md
  from wall_parts
), walls as (
  select *, case when plain_wall is not null then plain_wall when dm is null then md when md is null then dm
      when md::date = try_cast(local_date as date) then md when dm::date = try_cast(local_date as date) then dm when b like '%M' then md else dm end as wall
  from wall_times
), zoned as (
  select *, epoch_us(wall) as w, case when z = 'Z' then 0 when z <> '' then (case when left(z, 1) = '-' then -1 else 1 end) * (substr(z, 2, 2)::bigint * 3600 + right(z, 2)::bigint * 60) end as own_offset,
    epoch_us(timezone(zone_name, wall)) as at_zone, epoch_us(timezone(zone_name, timezone(zone_name, wall) - interval 1 hour)) as an_hour_before
  from walls
), inst as (
  select *, case when regexp_full_match(x, '\d{10}') then x::bigint * 1000000 when regexp_full_match(x, '\d{10}\.\d{1,9}') then split_part(x, '.', 1)::bigint * 1000000 + rpad(left(split_part(x, '.', 2), 6), 6, '0')::bigint
      when regexp_full_match(x, '\d{13}') then x::bigint * 1000 when regexp_full_match(x, '\d{16}') then x::bigint
      when own_offset is not null then w - own_offset * 1000000 when utc_offset_seconds is not null then w - utc_offset_seconds::bigint * 1000000
      when an_hour_before = w then at_zone - 3600000000 else at_zone end as us
  from zoned
)"""

SQL = {
    "p1_found": """
with hex as (
  select *, regexp_replace(regexp_replace(lower(trim(content_hash)), '^(0x|x'')', ''), '''$', '') as bytes from physical_records
), one as (
  select r.source_db_id, r.physical_record_id, g.scanned_at, r.last_seen_generation as generation_id, r.status, r.bytes
  from hex r join source_generations g on g.generation_id = r.last_seen_generation
  qualify row_number() over (partition by r.source_db_id, r.physical_record_id, r.last_seen_generation order by r.last_seen_at::timestamptz desc, (r.status = 'ACTIVE') desc, r.bytes desc) = 1
), snaps as (
  select source_db_id, generation_id, row_number() over (partition by source_db_id order by scanned_at, generation_id) as n
  from (select distinct source_db_id, generation_id, scanned_at from one)
), present as (
  select o.source_db_id, o.physical_record_id, s.n, o.bytes from one o join snaps s using (source_db_id, generation_id) where o.status = 'ACTIVE'
), pairs as (
  select source_db_id, physical_record_id, n as later, bytes, 1 as side from present where n > 1
  union all
  select source_db_id, physical_record_id, n + 1, bytes, 0 from present
), cmp as (
  select source_db_id, physical_record_id, later, max(case when side = 1 then bytes end) as now_bytes, max(case when side = 0 then bytes end) as old_bytes
  from pairs group by all
)
select s.generation_id, c.physical_record_id,
  case when old_bytes is null then 'added' when now_bytes is null then 'removed' else 'changed' end as change_type
from cmp c join snaps s on s.source_db_id = c.source_db_id and s.n = c.later
where old_bytes is distinct from now_bytes
""",
    "p2_found": """
with v as (
  select sid, sleep_start_utc as s, sleep_end_utc as t, is_nap_inferred as nap from sleep_sessions
  qualify row_number() over (partition by source_record_id order by imported_at desc, sid desc, sleep_start_utc desc nulls last, sleep_end_utc desc nulls last, is_nap_inferred desc) = 1
), r as (
  select *, max(t) over (partition by sid order by s, t rows between unbounded preceding and 1 preceding) as reach from v where t > s
), i as (
  select *, sum(case when reach is null or s > reach then 1 else 0 end) over (partition by sid order by s, t rows unbounded preceding) as island from r
), p as (
  select sid, island, min(s) as s, max(t) as t, min(case when nap = 1 then 1 else 0 end) as nap from i group by sid, island
), g as (
  select *, lead(s) over (partition by sid order by s) as next_s from p
)
select sid, case when nap = 1 then 'nap' else 'main' end as kind, s as start_utc, t as end_utc from g
union all
select sid, 'gap', t, next_s from g where next_s is not null
""",
    "p7_found": """
with days as (
  select sid, local_date::date as d,
    arg_max(steps, (updated_at, steps)) filter (where steps >= 0) as steps,
    arg_max(resting_hr, (updated_at, resting_hr)) filter (where resting_hr > 0) as rhr
  from daily_summary group by 1, 2
), span as (
  select sid, unnest(generate_series(min(d), max(d), interval 1 day))::date as d from days group by sid
), cal as (
  select span.sid, span.d, steps, rhr from span left join days on days.sid = span.sid and days.d = span.d
)
select sid, strftime(d, '%Y-%m-%d') as local_date,
  coalesce(sum(steps) over (partition by sid order by d range between interval 6 day preceding and current row), 0)::bigint as steps_7d,
  coalesce(sum(steps) over (partition by sid order by d range between interval 29 day preceding and current row), 0)::bigint as steps_30d,
  coalesce(sum(rhr) over (partition by sid order by d range between interval 29 day preceding and current row), 0)::bigint as rhr_30d_sum,
  count(rhr) over (partition by sid order by d range between interval 29 day preceding and current row) as rhr_30d_days
from cal
""",
    "p5_found": "with " + INST + """, r as (
  select distinct sid, floor(us / 600000000.0)::bigint as slot from inst where bpm is not null and us is not null
), n as (select sid, slot, lead(slot) over (partition by sid order by slot) as nxt from r)
select sid, unnest(range(slot + 1, nxt)) * 600 as slot_start_utc from n where nxt > slot + 1
""",
    "p5_series": "with " + INST + """, r as (
  select sid, floor(us / 600000000.0)::bigint as slot, count(*) as n, avg(bpm) as m from inst where bpm is not null and us is not null group by 1, 2
), x as (select *, coalesce(lead(slot) over (partition by sid order by slot), slot + 1) as nxt from r), s as (select *, unnest(range(slot, nxt)) as k from x)
select sid, k * 600 as slot_start_utc, case when k = slot then n else 0 end as n, case when k = slot then round(m, 6) end as mean_value, k <> slot as empty, round(m, 6) as carried_value from s
""",
    "p4_found": "with " + INST + """, once as (
  select sid, source_record_id as id, max(bpm) as x, max(us) as t from inst where bpm is not null and not isnan(bpm) and sid is not null and source_record_id is not null group by 1, 2
), timed as (select * from once where t is not null
), around as (
  select *, median(x) over w as level, list(x) over w as xs, row_number() over o as i, lag(x) over o as before, lead(x, 1) over o as x1, lead(x, 2) over o as x2, lead(x, 3) over o as x3
  from timed where x between 25 and 240 window o as (partition by sid order by t, id), w as (partition by sid order by t, id rows between 12 preceding and 12 following)
), spread as (select *, 1.4826::double * list_median(list_transform(xs, lambda v: abs(v - level))) as mad from around
), next_spread as (select *, lead(level) over o as level1, lead(mad) over o as mad1 from spread window o as (partition by sid order by i)
), stretches as (
  select sid, i, 1 as n, x as least, x as most, coalesce(before, x1) as b, x1 as a, level, mad from next_spread where x1 is not null
  union all select sid, i, 2, least(x, x1), greatest(x, x1), coalesce(before, x2), x2, level, mad from next_spread where x2 is not null
  union all select sid, i, 3, least(x, x1, x2), greatest(x, x1, x2), coalesce(before, x3), x3, level1, mad1 from next_spread where x3 is not null
), jumps as (
  select *, least - greatest(b, a) as up, least(b, a) - most as down, greatest(12.0::double, 3.0::double * mad) as margin from stretches
), hits as (
  select sid, i, n from jumps where greatest(up, down) >= margin and (case when up > 0 then least - level else level - most end) >= margin
), excursions as (select distinct sid, i + unnest(range(n)) as i from hits
), starts as (select *, case when x = lag(x) over o then 0 else 1 end as s from timed window o as (partition by sid order by t, id)
), numbered as (select *, sum(s) over (partition by sid order by t, id rows unbounded preceding) as run from starts
), runs as (select sid, run, count(*) as len from numbered group by 1, 2
), lengths as (select sid, len, count(*) as n, sum(count(*)) over (partition by sid order by len) as upto, sum(count(*)) over (partition by sid) as every from runs group by 1, 2
), judged as (
  select l.sid, l.len, l.upto - l.n as shorter, l.every, (select min(y.len) from lengths y where y.sid = l.sid and y.len < l.len and y.upto / (l.upto - l.n) >= 0.98) as typical from lengths l
), froze as (
  select sid, min(len) as least from judged where len >= 7 and greatest(shorter, 1) >= every - shorter and len >= ceil(coalesce(typical, 0) * 1.75) group by 1
)
select id as source_record_id from once where x < 25 or x > 240
union select id from around join excursions using (sid, i)
union select id from numbered join runs using (sid, run) join froze using (sid) where len >= least
""",
    "p6_found": "with " + INST + """, sl as (
  select *, case when zone_name is not null then epoch(timezone(zone_name, to_timestamp(sleep_end_utc)))::bigint - sleep_end_utc end as zone_offset from sleep_sessions where sleep_end_utc > sleep_start_utc
), sd as (
  select *, strftime(make_timestamp((sleep_end_utc - 1 + case when zone_name is not null then zone_offset else utc_offset_seconds end) * 1000000), '%Y-%m-%d') as right_date from sl
)
select 'heart_rate' as table_name, 'timestamp_utc' as field_name, source_record_id, (us // 1000)::varchar as normal_value from inst where us is not null and not regexp_full_match(timestamp_utc, '\\d{10}')
union select 'sleep_sessions', 'utc_offset_seconds', source_record_id, zone_offset::varchar from sd where zone_name is not null and utc_offset_seconds is distinct from zone_offset
union select 'sleep_sessions', 'local_date', source_record_id, right_date from sd where local_date <> right_date
""",
}
