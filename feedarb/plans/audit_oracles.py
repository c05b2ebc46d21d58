"""DuckDB SQL of the reports on ingest, the recorded log and removals."""

from __future__ import annotations

from feedarb.plans.oracles import FIRSTS, G, K, OBSERVED, ROSTER, evicted, feed, tick, verdict_select
from feedarb.plans.settings import OBSERVE, STALL
from feedarb.sources import derived as d

DECODED = f"""{feed()},
bodies as (select event_id, ts_us, {d.AUDIT_PARTITION} as partition, {d.AUDIT_TEXT} as body from ev),
log as (
  select partition, event_id, {d.AUDIT_BYTES} as value,
    row_number() over (partition by partition order by ts_us, event_id) - 1 as "offset"
  from bodies),
texts as (select partition, "offset", event_id, try(decode(value)) as t from log),
read as (
  select *, case when json_valid(t) and json_type(t) = 'OBJECT' then json_keys(t) end as k,
    case when json_valid(t) then t end as j from texts),
judged as (
  select *, case
    when k is null then 'malformed'
    when coalesce(json_type(j, '$.type'), 'NULL') = 'NULL' then 'malformed'
    when json_type(j, '$.schema_version') in ('VARCHAR', 'NULL', 'OBJECT', 'ARRAY') then 'malformed'
    when try_cast(json_extract_string(j, '$.schema_version') as double) > 1 then 'unrecognised'
    when json_type(j, '$.type') in ('ARRAY', 'OBJECT') then 'malformed'
    when json_extract_string(j, '$.type') not in ('tally', 'verdict', 'gate_stalled', 'kill_confirmed')
      then 'unrecognised'
    when not list_has_all(k, case json_extract_string(j, '$.type')
      when 'tally' then ['stream_type', 'symbol', 'window_start', 'emitted_at', 'counts', 'total_events']
      when 'verdict' then ['stream_type', 'symbol', 'window_start', 'window_end', 'slowest_source_id',
        'counts', 'total_events', 'sources_seen']
      when 'gate_stalled' then ['stream_type', 'symbol', 'sources_confirmed', 'sources_expected',
        'stalled_for_seconds', 'ignored_sources', 'emitted_at']
      else ['stream_type', 'symbol', 'source_id', 'terminated_at'] end) then 'malformed'
    when json_extract_string(j, '$.type') in ('tally', 'verdict') and json_type(j, '$.counts') <> 'OBJECT'
      then 'malformed'
    when json_extract_string(j, '$.type') = 'gate_stalled' and json_type(j, '$.ignored_sources') <> 'ARRAY'
      then 'malformed'
    else 'ok' end as decode_status from read),
good as (select *, case when decode_status = 'ok' then j end as g from judged),
decoded as (
  select partition, "offset", event_id, decode_status, json_extract_string(g, '$.type') as message_type,
    json_extract_string(g, '$.stream_type') as stream_type, json_extract_string(g, '$.symbol') as symbol,
    json_extract_string(g, '$.slowest_source_id') as slowest_source_id,
    json_extract_string(g, '$.source_id') as source_id,
    json_extract_string(g, '$.instance_id') as instance_id,
    json_extract_string(g, '$.window_end')::double as window_end,
    json_extract_string(g, '$.emitted_at')::double as emitted_at,
    json_extract_string(g, '$.terminated_at')::double as terminated_at,
    json_extract_string(g, '$.counts.a')::bigint as count_a,
    json_extract_string(g, '$.counts.b')::bigint as count_b,
    json_extract_string(g, '$.total_events')::bigint as total_events,
    json_extract_string(g, '$.sources_seen')::bigint as sources_seen,
    json_extract_string(g, '$.sources_confirmed')::bigint as sources_confirmed,
    array_to_string(json_extract_string(g, '$.ignored_sources[*]'), ',') as ignored_list,
    json_extract_string(g, '$.reason') as reason,
    json_extract_string(g, '$.correlation_id') as correlation_id
  from good)"""

OCTETS = "\n".join(
    f"""    , nullif(regexp_extract(name, '^ip-(\\d{{1,3}})-(\\d{{1,3}})-(\\d{{1,3}})-(\\d{{1,3}})(\\.|$)', {i}), '')::int as o{i}"""
    for i in range(1, 5)
)

NODES = f"""nodes as (
  select {d.node_name('s_suppkey')} as name, {d.NODE_ROLE} as role, {d.NODE_PROVIDER} as provider_id
  from supplier),
addressed as (select * {OCTETS} from nodes),
known as (
  select name, role, nullif(regexp_extract(provider_id, '^aws://[^/]*/[^/]*/(i-[0-9a-f]+)$', 1), '') as provider_instance,
    case when o1 <= 255 and o2 <= 255 and o3 <= 255 and o4 <= 255
      then o1 || '.' || o2 || '.' || o3 || '.' || o4 end as name_ip
  from addressed),
machines as (select *, unnest([0, 1]) as copy from supplier),
running as (
  select {d.INSTANCE_IP} as ip, count(*) as n, min({d.INSTANCE_ID}) as id
  from machines where ({d.INSTANCE_KEPT}) and {d.INSTANCE_STATE} = 'running' group by all),
ready as (
  select name, role,
    case when role is null then 'node has no ''role'' label; only nodes labelled role=listener may be removed'
      when role <> 'listener' then concat('node is role=''', role, ''', not ''listener''') end as label_problem,
    case when provider_instance is null then name_ip end as private_ip,
    coalesce(provider_instance, case when n = 1 then id end) as instance_id,
    case when provider_instance is not null then 'provider_id' when name_ip is null then 'unidentifiable'
      when n is null then 'not_found' when n > 1 then 'ambiguous' else 'address' end as identified_by
  from known left join running on provider_instance is null and ip = name_ip)"""

ACTIONS = f"""{DECODED}, {NODES},
outcomes as (
  select ev.stream_type, ev.symbol, {d.node_name('user_id')} as source_id, log."offset" as verdict_offset,
    {d.OUTCOME_STAGE} as stage, {d.OUTCOME_OK} as ok, {d.OUTCOME_INSTANCE} as instance_id,
    case when {d.OUTCOME_OK} then ts_us + (event_id % 200) * 1000000 end as terminated_us
  from ev join log using (event_id) where {d.NAMING_VERDICT}),
handled as (
  select {G}, source_id, min(verdict_offset) as handled_offset from outcomes
  where ok and source_id in (select name from ready where label_problem is null
    and identified_by in ('provider_id', 'address'))
  group by all),
actions as (
  select m.*, coalesce(m.message_type = 'verdict' and m.slowest_source_id is not null
      and not coalesce(h.handled_offset < m."offset", false), false) as act,
    case when decode_status = 'unrecognised' then 'unrecognised message type or schema version'
      when message_type = 'tally' then 'not a verdict (Tally)'
      when message_type = 'gate_stalled' then 'not a verdict (GateStalled)'
      when message_type = 'kill_confirmed' then 'not a verdict (KillConfirmed)'
      when slowest_source_id is null then 'verdict reached no conclusion: ' || coalesce(reason, 'no reason given')
      when h.handled_offset < m."offset"
        then 'already acted on ' || slowest_source_id || ' for ' || m.stream_type || '/' || m.symbol
      else slowest_source_id || ' was slowest over ' || total_events || ' events from ' || sources_seen || ' sources'
    end as action_reason
  from decoded m left join handled h on h.stream_type = m.stream_type and h.symbol = m.symbol
    and h.source_id = m.slowest_source_id
  where decode_status <> 'malformed'),
plan as (
  select partition, "offset", stream_type, symbol, slowest_source_id as source_id, correlation_id,
    case when name is null then 'refused:node_not_found'
      when label_problem is not null then 'refused:ineligible_label'
      when identified_by = 'unidentifiable' then 'refused:unidentifiable_instance'
      else 'terminate' end as planned_action,
    label_problem, private_ip, ready.instance_id, identified_by
  from actions left join ready on name = slowest_source_id where act),
settled as (
  select plan.*,
    case when ok and identified_by not in ('provider_id', 'address') then 'terminate' else stage end as stage,
    ok and identified_by in ('provider_id', 'address') as ok,
    case when identified_by in ('provider_id', 'address') then terminated_us end as terminated_us
  from plan left join outcomes on outcomes.stream_type = plan.stream_type and outcomes.symbol = plan.symbol
    and outcomes.source_id = plan.source_id and verdict_offset = "offset"
  where planned_action = 'terminate'),
named as (
  select v.*, (select min(c."offset") from decoded c where c.message_type = 'kill_confirmed'
      and c.stream_type = v.stream_type and c.symbol = v.symbol and c.source_id = v.slowest_source_id
      and c."offset" > v."offset") as confirmed_offset
  from decoded v where v.message_type = 'verdict' and v.slowest_source_id is not null)"""

RETIRED = f"""namings as (
  select distinct {G}, {d.NAMED_SOURCE} as source_id, {d.NAMED_AT} as named_us
  from (select {G}, unnest([0, 1, 2]) as naming from ev)),
retired as (select {G}, source_id, min(named_us) as from_us from namings group by all),
flagged as (
  select copies.*, coalesce(arr_us >= from_us, false) as ignored
  from copies left join retired using ({G}, source_id)),
fleet as (
  select {G}, source_id, min(arr_us) as first_us, min(seq_offset) as first_offset, max(arr_us) as last_us
  from flagged where not ignored group by all)"""

CLOSURES = f"""{RETIRED},
ends as (select {G}, max(last_us) as last_us, min(first_us) as started_us from fleet group by all),
closings as (
  select {G}, started_us as closed_us, null as gone from ends
  union all select distinct {G}, named_us, source_id from namings),
restored as (
  select c.stream_type, c.symbol, c.closed_us, f.first_us,
    row_number() over (partition by c.stream_type, c.symbol, c.closed_us order by f.first_offset) as nth
  from closings c join fleet f on f.stream_type = c.stream_type and f.symbol = c.symbol
    left join retired r on r.stream_type = c.stream_type and r.symbol = c.symbol
      and r.source_id = f.source_id and r.from_us <= c.closed_us
  where r.source_id is null),
resumed as (
  select c.stream_type, c.symbol, c.closed_us, min(g.arr_us) as next_us
  from closings c join flagged g on g.stream_type = c.stream_type and g.symbol = c.symbol
    and g.arr_us >= c.closed_us where not g.ignored group by all),
closures as (
  select c.stream_type, c.symbol, c.closed_us,
    case when x.first_us is not null and n.next_us is not null then greatest(x.first_us, n.next_us)
      else e.last_us end as until_us
  from closings c join ends e using ({G}) left join resumed n using ({G}, closed_us)
  left join restored x on x.stream_type = c.stream_type and x.symbol = c.symbol
    and x.closed_us = c.closed_us and x.nth = {STALL.expected_sources})"""

STALL_US = f"{int(STALL.stall_warn_seconds)}::BIGINT * 1000000"

STALLS = f"""with {feed()}, {CLOSURES},
warned as (select {G}, closed_us,
    unnest(generate_series({tick(f'closed_us + {STALL_US}')}, until_us, {STALL_US})) as emitted_us
  from closures),
gone as (select w.stream_type, w.symbol, w.emitted_us, string_agg(source_id, ',' order by source_id) as ignored_sources
  from warned w join retired r on r.stream_type = w.stream_type and r.symbol = w.symbol and r.from_us <= w.emitted_us
  group by all),
present as (select f.*, r.from_us from fleet f left join retired r using ({G}, source_id))
select w.stream_type, w.symbol, w.closed_us, w.emitted_us, count(f.source_id) as sources_confirmed,
  coalesce(any_value(g.ignored_sources), '') as ignored_sources,
  {STALL.expected_sources}::BIGINT as sources_expected, w.emitted_us - w.closed_us as stalled_for_us
from warned w left join gone g on g.stream_type = w.stream_type and g.symbol = w.symbol
  and g.emitted_us = w.emitted_us
left join present f on f.stream_type = w.stream_type and f.symbol = w.symbol and f.first_us < w.emitted_us
  and (f.from_us is null or f.from_us > w.emitted_us)
group by w.stream_type, w.symbol, w.closed_us, w.emitted_us"""


def seconds(us: str) -> str:
    """Epoch seconds with six places, as the wire has them."""
    return f"({us} // 1000000) || '.' || lpad(({us} % 1000000)::varchar, 6, '0')"


CAPTURED = f"""lines as (
  select event_id, lower({d.CAPTURED_STREAM}) as stream_type, 'sym' || (user_id % 3) as symbol,
    replace({d.CAPTURED_LINE}, '{{f}}', {d.CAPTURED_ID_FIELD}) as line from events),
looked as (
  select *, case stream_type when 'trade' then 't' when 'depth' then 'd' when 'aggtrade' then 'aT' end as pfx,
    case stream_type when 'trade' then '$.t' when 'depth' then '$.u' when 'aggtrade' then '$.a' end as path,
    case when json_valid(line) then json_type(line) = 'OBJECT' else false end as good from lines),
shaped as (
  select event_id, stream_type, symbol,
    case when good then pfx || ':' || json_extract_string(line, path) end as msg_key,
    case when path is null then 'unknown_stream' when not good then 'bad_json'
      when json_extract_string(line, path) is null then 'missing_id' end as drop_reason from looked)"""


def ingest_sql() -> dict[str, str]:
    return {
        "raw_validation": f"""with {feed()},
built as (
  select *, {d.RAW_KEY} as k, list_concat(
    case when {d.RAW_NO_SOURCE} then [] else [{{'n': 'source_id', 'v': source_id}}] end,
    [{{'n': 'stream_type', 'v': stream_type}}], [{{'n': 'symbol', 'v': {d.RAW_SYMBOL}}}],
    case when {d.RAW_TWICE} then [{{'n': 'symbol', 'v': 'second'}}] else [] end) as h
  from copies),
seen as (
  select seq_offset, nullif(k, '') as msg_key,
    nullif(list_filter(h, lambda x: x.n = 'stream_type')[1].v, '') as stream_type,
    nullif(list_filter(h, lambda x: x.n = 'symbol')[1].v, '') as symbol,
    nullif(list_filter(h, lambda x: x.n = 'source_id')[1].v, '') as source_id from built)
select {K}, source_id, seq_offset,
  case when stream_type is null or symbol is null or source_id is null then 'missing_header'
    when msg_key is null then 'missing_key' end as drop_reason from seen""",
        "rejected_messages": f"""with {feed()}
select 'market-data-raw' as topic, 0 as partition, seq_offset as "offset",
  case when {d.RAW_NO_SOURCE} or {d.RAW_SYMBOL} = '' then 'missing_header' else 'missing_key' end as drop_reason,
  {d.RAW_KEY} as key
from copies where {d.RAW_NO_SOURCE} or {d.RAW_SYMBOL} = '' or {d.RAW_KEY} is null""",
        "arbitrated_rows": f"""with {feed()},
good as (select * from copies where not ({d.RAW_NO_SOURCE} or {d.RAW_SYMBOL} = '' or {d.RAW_KEY} is null)),
first as (select {K}, arg_min(source_id, seq_offset) as source_id, any_value(event_id) as event_id,
    any_value(event_id % 53 = 0) as twice from good group by all)
select msg_key as key, '{{"id":' || event_id || '}}' as value,
  'source_id=' || source_id || ',stream_type=' || stream_type || ',symbol=' || symbol
    || case when twice then ',symbol=second' else '' end as headers,
  (('0x' || substr(sha256(lower(stream_type) || chr(0) || lower(symbol)), 1, 16))::UBIGINT % 6)::INT as partition
from first""",
        "message_keys": f"with {CAPTURED} select event_id, {K}, drop_reason from shaped",
        "dropped_by_reason": f"""with {CAPTURED}, {feed()},
raw as (select case when {d.RAW_NO_SOURCE} or {d.RAW_SYMBOL} = '' then 'missing_header'
  when {d.RAW_KEY} is null then 'missing_key' end as drop_reason from copies)
select drop_reason, count(*) as dropped
from (select drop_reason from raw union all select drop_reason from shaped)
where drop_reason is not null group by all""",
        "parsed_keys": f"""with written as (select event_id, {d.KEY_TEXT} as msg_key from events),
cut as (select *, instr(msg_key, ':') as colon from written),
parts as (select *, colon > 1 and length(msg_key) > colon as good from cut)
select event_id, case when good then left(msg_key, colon - 1) end as key_prefix,
  case when good then substr(msg_key, colon + 1) end as key_event_id, not good as malformed from parts""",
        "topic_partition": """with h as (select c_custkey,
  ('0x' || substr(sha256(lower(c_mktsegment) || chr(0) || lower(c_name)), 1, 16))::UBIGINT as slot from customer)
select c_custkey, (slot % 6)::INT as partition_6, (slot % 1000)::INT as partition_1000 from h""",
        "audit_partition": f"""with named as (select event_id, lower({d.CAPTURED_STREAM}) as s from events),
h as (select *, list_position(['trade', 'depth', 'aggtrade'], s) as place,
  ('0x' || substr(sha256(s), 1, 16))::UBIGINT as slot from named)
select event_id, (case when place is not null then place - 1 else slot % 3 end)::INT as partition_3,
  (case when place is not null then (place - 1) % 2 else slot % 2 end)::INT as partition_2 from h""",
        "tumbling_leaderboard": f"""with {feed()}, {FIRSTS},
wins as (select {G}, epoch_us(time_bucket(interval 1 day, make_timestamp(first_us))) as window_start_us,
  winner as source_id, count(*) as wins from firsts group by all)
select *, (rank() over (partition by {G}, window_start_us order by wins desc))::INT as place from wins""",
    }


def recorded_sql() -> dict[str, str]:
    return {
        "ignore_filtered_feed": f"""with {feed()}, {RETIRED}
select {K}, min(seq_offset) as first_offset, arg_min(source_id, seq_offset) as source_id,
  arg_min(arr_us, seq_offset) as arr_us from flagged where not ignored group by all""",
        "gate_closures": f"with {feed()}, {CLOSURES} select * from closures",
        "stalls_encoded": f"""with stalls as ({STALLS})
select stream_type as key, '{{"type":"gate_stalled","schema_version":1,"stream_type":"' || stream_type
  || '","symbol":"' || symbol || '","sources_confirmed":' || sources_confirmed || ',"sources_expected":'
  || sources_expected || ',"stalled_for_seconds":' || {seconds('stalled_for_us')} || ',"ignored_sources":['
  || case when ignored_sources = '' then '' else '"' || replace(ignored_sources, ',', '","') || '"' end
  || '],"emitted_at":' || {seconds('emitted_us')} || '}}' as value,
  case stream_type when 'trade' then 0 when 'depth' then 1 else 2 end as partition from stalls""",
        "gate_stalls": STALLS,
        "feed_counters": f"""with {feed()}, {RETIRED},
ranked as (select *, row_number() over (partition by {K}, ignored order by seq_offset) as nth from flagged)
select {G}, count(*) as consumed, count(*) filter (where not ignored and nth = 1) as forwarded,
  count(*) filter (where not ignored and nth > 1) as duplicates,
  count(*) filter (where ignored) as ignored from ranked group by all""",
        "verdict_recheck": f"""with {OBSERVED},
told as ({verdict_select('wins', G + ', window_no', OBSERVE.minimum_events)}),
log as (
  select {G}, window_no, window_start_us, window_end_us, slowest_source_id, sources_seen, reason,
    ({d.RECORDED_TOTAL})::BIGINT as total_events
  from told join windows using ({G}, window_no)),
gone as (
  select {G}, slowest_source_id as source_id, min(window_end_us) as from_us
  from log where slowest_source_id is not null group by all),
remaining as (
  select c.* from copies c left join gone g on g.stream_type = c.stream_type and g.symbol = c.symbol
    and g.source_id = c.source_id where from_us is null or arr_us < from_us),
left_over as (
  with copies as (select * from remaining), {FIRSTS}, {evicted(OBSERVE.expected_sources, OBSERVE.lag)}
  select * from evicted),
crew as (with copies as (select * from remaining), {ROSTER} select * from roster),
opened as (
  select l.stream_type, l.symbol, l.window_start_us,
    coalesce(min(case when c.source_id is not null then r.seq_offset end), min(r.seq_offset)) as open_offset
  from log l join remaining r on r.stream_type = l.stream_type and r.symbol = l.symbol and r.arr_us = l.window_start_us
    left join crew c on c.stream_type = r.stream_type and c.symbol = r.symbol and c.first_offset = r.seq_offset
  where not exists (select 1 from log b where b.stream_type = l.stream_type and b.symbol = l.symbol
    and b.window_end_us = l.window_start_us and b.slowest_source_id is null)
  group by all),
counted as (
  select l.stream_type, l.symbol, l.window_no, e.winner as source_id, count(*) as n
  from log l left join opened o using ({G}, window_start_us)
    join left_over e on e.stream_type = l.stream_type and e.symbol = l.symbol
    and e.evict_us >= l.window_start_us and e.evict_us < l.window_end_us
    and e.evict_offset >= coalesce(o.open_offset, e.evict_offset)
  group by all),
present as (
  select l.stream_type, l.symbol, l.window_no, c.source_id
  from log l join crew c on c.stream_type = l.stream_type and c.symbol = l.symbol and c.first_us < l.window_end_us
    left join gone g on g.stream_type = c.stream_type and g.symbol = c.symbol and g.source_id = c.source_id
  where g.from_us is null or g.from_us > l.window_start_us),
again_wins as (
  select {G}, window_no, source_id, coalesce(n, 0) as wins
  from present full join counted using ({G}, window_no, source_id)),
again as ({verdict_select('again_wins', G + ', window_no', OBSERVE.minimum_events)})
select l.* exclude (window_no), a.total_events as recomputed_events, a.slowest_source_id as recomputed_slowest,
  a.window_no is not null and a.slowest_source_id is not distinct from l.slowest_source_id
    and a.total_events is not distinct from l.total_events and a.sources_seen is not distinct from l.sources_seen
    and a.reason is not distinct from l.reason as matched
from log l left join again a using ({G}, window_no)""",
        "audit_encoded": f"""with {OBSERVED},
told as ({verdict_select('wins', G + ', window_no', OBSERVE.minimum_events)}),
maps as (select {G}, window_no, string_agg('"' || source_id || '":' || wins, ',' order by source_id) as counts
  from wins group by all)
select stream_type as key, '{{"type":"verdict","schema_version":1,"stream_type":"' || stream_type
  || '","symbol":"' || symbol || '","window_start":' || (window_start_us // 1000000) || '.'
  || lpad((window_start_us % 1000000)::varchar, 6, '0') || ',"window_end":' || (window_end_us // 1000000)
  || '.' || lpad((window_end_us % 1000000)::varchar, 6, '0') || ',"slowest_source_id":'
  || coalesce('"' || slowest_source_id || '"', 'null') || ',"counts":{{' || counts || '}},"total_events":'
  || total_events || ',"sources_seen":' || sources_seen || ',"reason":' || coalesce('"' || reason || '"', 'null')
  || ',"correlation_id":null}}' as value,
  case stream_type when 'trade' then 0 when 'depth' then 1 else 2 end as partition
from told join maps using ({G}, window_no) join windows using ({G}, window_no)""",
    }


def audit_sql() -> dict[str, str]:
    return {
        "audit_decoded": f"""with {DECODED}
select * exclude (event_id, ignored_list),
  case when message_type = 'gate_stalled' then ignored_list end as ignored_sources,
  case when message_type = 'verdict' then slowest_source_id is not null end as is_actionable from decoded""",
        "audit_order_check": f"""with {DECODED}
select {G}, source_id, partition, "offset", exists (select 1 from decoded v
  where v.message_type = 'verdict' and v.stream_type = c.stream_type and v.symbol = c.symbol
    and v.slowest_source_id = c.source_id and v."offset" < c."offset") as preceded
from decoded c where message_type = 'kill_confirmed'""",
        "audit_traffic": f"""with {DECODED}
select case decode_status when 'malformed' then 'malformed' when 'unrecognised' then 'unknown' else
  case message_type when 'tally' then 'Tally' when 'verdict' then 'VerdictMessage'
    when 'gate_stalled' then 'GateStalled' else 'KillConfirmed' end end as message_type,
  count(*) as messages from decoded group by all""",
        "verdict_counts": f"""with {DECODED}
select {G}, slowest_source_id is not null as is_actionable, count(*) as verdicts
from decoded where message_type = 'verdict' group by all""",
        "audit_counts": f"""with {DECODED}
select {G}, message_type, count(*) as messages from decoded where message_type is not null group by all""",
        "last_removal": f"""with {DECODED}
select {G}, max(terminated_at) as last_removal_at from decoded where message_type = 'kill_confirmed' group by all""",
        "node_identity": f"""with {NODES}
select name, provider_instance, name_ip, case when provider_instance is null then name_ip end as lookup_ip from known""",
        "verdict_actions": f"""with {ACTIONS} select partition, "offset", act, action_reason from actions""",
        "removal_plan": f"""with {ACTIONS} select * exclude (correlation_id) from plan""",
        "removal_plan_modes": f"""with {ACTIONS},
tried as (select a.partition, a."offset", a.slowest_source_id as source_id, name, label_problem
  from actions a left join ready on name = slowest_source_id where act)
select 'dry_run' as mode, partition, "offset", source_id, 'dry_run' as planned_action from tried
union all select 'cordon_only', partition, "offset", source_id, case when name is null then 'refused:node_not_found'
  when label_problem is not null then 'refused:ineligible_label' else 'cordon_drain' end from tried""",
        "confirmations_encoded": f"""with {ACTIONS}
select stream_type as key, '{{"type":"kill_confirmed","schema_version":1,"stream_type":"' || stream_type
  || '","symbol":"' || symbol || '","source_id":"' || source_id || '","instance_id":"' || instance_id
  || '","terminated_at":' || {seconds('terminated_us')} || ',"correlation_id":'
  || coalesce('"' || correlation_id || '"', 'null') || '}}' as value,
  case stream_type when 'trade' then 0 when 'depth' then 1 else 2 end as partition from settled where ok""",
        "confirmations": f"""with {ACTIONS}
select {G}, source_id, instance_id, terminated_us, correlation_id from settled where ok""",
        "removal_counters": f"""with {ACTIONS},
counted as (
  select case when planned_action like 'refused:%' then 'refused' else 'attempted' end as counter,
    case when planned_action like 'refused:%' then substr(planned_action, 9) end as detail, {G} from plan
  union all
  select case when ok then 'succeeded' else 'failed' end, case when not ok then stage end, {G}
  from settled where ok is not null)
select counter, detail, {G}, count(*) as value from counted group by all""",
        "kill_reconciliation": f"""with {ACTIONS},
judged_names as (select n.stream_type, n.symbol, n.confirmed_offset is not null as done,
    coalesce(p.planned_action like 'refused:%', false) as refused
  from named n left join plan p on p.partition = n.partition and p."offset" = n."offset")
select {G}, count(*) as named, count(*) filter (where refused) as refused,
  count(*) filter (where not refused and done) as confirmed,
  count(*) filter (where not refused and not done) as outstanding from judged_names group by all""",
        "confirm_latency_histogram": f"""with {ACTIONS},
waits as (select n.stream_type, n.symbol, (c.terminated_at - n.window_end) / 1440.0 as waited
  from named n join decoded c on c.partition = n.partition and c."offset" = n.confirmed_offset),
bounds as (select unnest([1, 5, 10, 20, 30, 45, 60, 90, 120, 180, 'infinity'::double]) as le)
select {G}, le, count(*) filter (where waited <= le) as n from waits cross join bounds group by all""",
    }


def oracle_sql() -> dict[str, str]:
    from feedarb.plans.oracles import arbitration_sql

    return {**arbitration_sql(), **ingest_sql(), **recorded_sql(), **audit_sql()}
