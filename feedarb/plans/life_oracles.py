"""SQL for the reports on all lives: one copy of each group after the other, by recursion."""

from __future__ import annotations

from feedarb.plans.audit_oracles import RETIRED
from feedarb.plans.oracles import G, K, OBS_W, feed, tick
from feedarb.plans.settings import OBSERVE
from feedarb.sources import derived as d

# An entry of the cache: key, winner, first offset and time, sources, number of its admission.
ENTRY = "struct(k varchar, w varchar, o bigint, u bigint, s varchar[], n bigint)"


def walk(copies: str, n: int, lag: int) -> str:
    """CTEs ``fed`` and ``walk``: what is live after each copy, and what the copy made leave."""
    leaves = f"(len(e.s) >= {n} or admitted - e.n >= {lag})"
    return f"""fed as materialized (
  select {K}, source_id, arr_us, seq_offset, row_number() over (partition by {G} order by seq_offset) as i from {copies}),
walk as (
  select {G}, null::varchar as msg_key, 0::bigint as i, 0::bigint as admitted, 0::bigint as seq_offset, 0::bigint as arr_us,
    false as forwarded, []::{ENTRY}[] as live, []::{ENTRY}[] as gone
  from (select distinct {G} from {copies})
  union all
  select {G}, msg_key, i, admitted, seq_offset, arr_us, forwarded,
    list_filter(seen, lambda e: not {leaves}) as live, list_filter(seen, lambda e: {leaves}) as gone
  from (
    select {G}, msg_key, i, seq_offset, arr_us, forwarded, admitted + forwarded::bigint as admitted,
      case when forwarded then list_append(live,
        {{k: msg_key, w: source_id, o: seq_offset, u: arr_us, s: [source_id], n: admitted + 1}}::{ENTRY})
      else list_transform(live, lambda e: case when e.k = msg_key and not list_contains(e.s, source_id)
        then {{k: e.k, w: e.w, o: e.o, u: e.u, s: list_append(e.s, source_id), n: e.n}}::{ENTRY} else e end) end as seen
    from (
      select f.*, w.admitted, w.live, not list_contains(list_transform(w.live, lambda e: e.k), f.msg_key) as forwarded
      from walk w join fed f on f.stream_type = w.stream_type and f.symbol = w.symbol and f.i = w.i + 1)))"""


COUNT = "struct(s varchar, n bigint)"


def _zero(sources: str) -> str:
    return f"list_transform({sources}, lambda x: {{s: x, n: 0::bigint}}::{COUNT})"


def _counted(counts: str, source: str, more: str) -> str:
    """Counts with ``more`` for a source, which joins them if it is new."""
    return f"""case when list_contains(list_transform({counts}, lambda c: c.s), {source})
        then list_transform({counts}, lambda c: {{s: c.s, n: c.n + case when c.s = {source} then {more} else 0 end}}::{COUNT})
        else list_append({counts}, {{s: {source}, n: {more}}}::{COUNT}) end"""


def loop(n: int, lag: int, minimum: int) -> str:
    """CTE ``steps``: a group's gate, windows and cache after each copy or confirmation.

    Windows that close since the input before are judged first: the one that was open, then
    ``idle`` more without any event, which can name nobody because ``minimum`` is above 0.
    """
    leaves = f"(len(e.s) >= {n} or admitted - e.n >= {lag})"
    return f"""groups as (select {G}, min(arr_us) as started_us from copies group by all),
removed as (
  select {G}, {d.CONFIRMED_SOURCE} as source_id, {d.CONFIRMED_AT} as arr_us
  from (select groups.*, unnest(range(3)) as removal from groups) where {d.CONFIRMED_KEPT}),
inputs as materialized (
  select *, row_number() over (partition by {G} order by arr_us, tag, seq_offset) as i from (
    select {K}, source_id, arr_us, 1 as tag, seq_offset from copies
    union all select {G}, null, r.source_id, r.arr_us, 0, -1 from removed r join groups using ({G}) where r.arr_us > started_us)),
steps as (
  select {G}, 0::bigint as i, 0::bigint as arr_us, 0::bigint as admitted, []::{ENTRY}[] as live, []::varchar[] as present,
    []::varchar[] as ignored, false as is_open, null::bigint as start, []::{COUNT}[] as counts, false as closing, false as opening,
    null::bigint as from_us, null::bigint as to_us, []::{COUNT}[] as told, 0::bigint as total, null::varchar as named,
    null::varchar as reason, 0::bigint as idle, []::varchar[] as waiting
  from groups
  union all
  select {G}, i, arr_us, admitted, live, present, ignored, is_open, start,
    case when not (is_open and heard) then counts when len(gone) = 0 then {_counted('counts', 'source_id', '0::bigint')}
      else {_counted(f"({_counted('counts', 'source_id', '0::bigint')})", 'gone[1].w', '1::bigint')} end as counts,
    closing, opening, from_us, to_us, told, total, named, reason, idle, waiting
  from (select *, list_filter(seen, lambda e: {leaves}) as gone, list_filter(seen, lambda e: not {leaves}) as live
  from (select * exclude (admitted, live), admitted + forwarded::bigint as admitted,
    case when not heard then live when forwarded then list_append(live,
      {{k: msg_key, w: source_id, o: seq_offset, u: arr_us, s: [source_id], n: admitted + 1}}::{ENTRY})
    else list_transform(live, lambda e: case when e.k = msg_key and not list_contains(e.s, source_id)
      then {{k: e.k, w: e.w, o: e.o, u: e.u, s: list_append(e.s, source_id), n: e.n}}::{ENTRY} else e end) end as seen
  from (select * exclude (is_open, start, counts), is_open or opening as is_open,
    case when opening then arr_us else start end as start, case when opening then {_zero('present')} else counts end as counts,
    heard and not list_contains(list_transform(live, lambda e: e.k), msg_key) as forwarded
  from (select *, heard and not is_open and len(present) >= {n} as opening
  from (select * exclude (present, ignored),
    case when tag = 0 then list_filter(present, lambda x: x <> source_id)
      when heard and not list_contains(present, source_id) then list_append(present, source_id) else present end as present,
    case when tag = 0 then list_append(ignored, source_id) else ignored end as ignored
  from (select *, tag = 1 and not list_contains(ignored, source_id) as heard
  from (select * exclude (is_open, start, present, ignored, counts), counts as told, start as from_us,
    is_open and named is null as is_open,
    list_filter(present, lambda x: named is null or x <> named) as present,
    case when named is null then ignored else list_append(ignored, named) end as ignored,
    case when named is not null then 0 when closing then (arr_us - to_us) // ({OBS_W}) else 0 end as idle,
    case when named is not null then null when closing then to_us + (arr_us - to_us) // ({OBS_W}) * ({OBS_W}) else start end as start,
    case when closing then {_zero('present')} else counts end as counts, present as waiting
  from (select *, case when closing and len(counts) >= 2 and total >= {minimum} and len(slow) = 1 then slow[1].s end as named,
    case when not closing then null when len(counts) < 2 then 'fewer than two sources contributed'
      when total < {minimum} then 'only ' || total || ' events, need {minimum}'
      when len(slow) > 1 then 'tie between ' || len(slow) || ' sources on ' || slow[1].n || ' wins' end as reason
  from (select *, coalesce(list_sum(list_transform(counts, lambda c: c.n)), 0)::bigint as total,
    list_filter(counts, lambda c: c.n = list_min(list_transform(counts, lambda x: x.n))) as slow
  from (select f.*, s.admitted, s.live, s.present, s.ignored, s.is_open, s.start, s.counts, {tick(f's.start + {OBS_W}')} as to_us,
      coalesce(s.is_open and {tick(f's.start + {OBS_W}')} <= f.arr_us, false) as closing
    from steps s join inputs f on f.stream_type = s.stream_type and f.symbol = s.symbol and f.i = s.i + 1))))))))))),
judged as (
  select {G}, from_us as window_start_us, to_us as window_end_us, told, named, total, reason from steps where closing
  union all
  select {G}, to_us + j * ({OBS_W}), to_us + (j + 1) * ({OBS_W}), {_zero('waiting')}, null, 0,
    case when len(waiting) < 2 then 'fewer than two sources contributed' else 'only 0 events, need {minimum}' end
  from (select *, unnest(range(idle)) as j from steps where closing))"""


def oracle_sql() -> dict[str, str]:
    n, lag = OBSERVE.expected_sources, OBSERVE.lag
    whole = f"with recursive {feed()}, {walk('copies', n, lag)}"
    kept = f"""with recursive {feed()}, {RETIRED},
heard as (select * from flagged where not ignored), {walk('heard', n, lag)}"""
    closed = f"with recursive {feed()}, {loop(n, lag, OBSERVE.minimum_events)}"
    return {
        "closed_loop_verdicts": f"""{closed}
select {G}, window_start_us, window_end_us, named as slowest_source_id, total as total_events,
  len(told) as sources_seen, reason from judged""",
        "closed_loop_wins": f"""{closed}
select {G}, window_start_us, window_end_us, c.s as source_id, c.n as wins
from (select {G}, window_start_us, window_end_us, unnest(told) as c from judged)""",
        "closed_loop_closures": f"""{closed},
closed as (
  select {G}, 0 as i, started_us as closed_us from groups union all select {G}, i, to_us from steps where named is not null),
ended as (select {G}, max(arr_us) as last_us from steps group by all)
select c.stream_type, c.symbol, c.closed_us, coalesce(min(o.arr_us), any_value(last_us)) as until_us
from closed c join ended e on e.stream_type = c.stream_type and e.symbol = c.symbol
left join steps o on o.stream_type = c.stream_type and o.symbol = c.symbol and o.opening and o.i >= c.i
group by c.stream_type, c.symbol, c.i, c.closed_us""",
        "forwarded_feed": f"""{whole}
select c.stream_type, c.symbol, c.msg_key, c.source_id, c.seq_offset, c.arr_us, c.value
from copies c join walk w using ({G}, seq_offset) where w.forwarded and w.i > 0""",
        "copy_outcomes": f"""{kept}
select f.stream_type, f.symbol, f.msg_key, f.source_id, f.seq_offset, case when f.ignored then 'ignored'
  when w.forwarded then 'forwarded' else 'duplicate' end as outcome
from flagged f left join walk w on w.stream_type = f.stream_type and w.symbol = f.symbol
  and w.seq_offset = f.seq_offset and w.i > 0""",
        "evictions_all_lives": f"""{whole}
select {G}, e.k as msg_key, e.w as winner, e.o as first_offset, e.n as admitted_seq, seq_offset as evict_offset,
  arr_us as evict_us, len(e.s) >= {n} as complete, len(e.s) as copies_seen
from (select {G}, seq_offset, arr_us, unnest(gone) as e from walk)""",
        "pending_all_lives": f"""{whole}
select {G}, len(live) as pending, list_min(list_transform(live, lambda e: e.o)) as oldest_offset
from walk where (stream_type, symbol, i) in (select (stream_type, symbol, max(i)) from walk group by {G})""",
        "feed_counters_all_lives": f"""{kept},
fates as (select {G}, count(*) filter (where forwarded) as forwarded, count(*) filter (where not forwarded) as duplicates
  from walk where i > 0 group by all)
select {G}, count(*) as consumed, any_value(forwarded) as forwarded, any_value(duplicates) as duplicates,
  count(*) filter (where ignored) as ignored from flagged join fates using ({G}) group by all""",
        "forwarded_rows": f"""with recursive {feed()},
good as (select * from copies where not ({d.RAW_NO_SOURCE} or {d.RAW_SYMBOL} = '' or {d.RAW_KEY} is null)),
{walk('good', n, lag)}
select g.msg_key as key, '{{"id":' || event_id || '}}' as value,
  'source_id=' || source_id || ',stream_type=' || g.stream_type || ',symbol=' || g.symbol
    || case when event_id % 53 = 0 then ',symbol=second' else '' end as headers,
  (('0x' || substr(sha256(lower(g.stream_type) || chr(0) || lower(g.symbol)), 1, 16))::UBIGINT % 6)::INT as partition
from good g join walk w using ({G}, seq_offset) where w.forwarded and w.i > 0""",
    }
