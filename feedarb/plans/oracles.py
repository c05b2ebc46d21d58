"""The registered reports as DuckDB SQL, written apart from the operators.

Only the derived feeds share their expressions with ``sources.derived``: both
engines must start from the same copies.
"""

from __future__ import annotations

from feedarb.plans.settings import OBSERVE
from feedarb.sources import derived as d

G = "stream_type, symbol"
K = "stream_type, symbol, msg_key"


def feed(redelivery: bool = True) -> str:
    """CTEs ``ev`` (events) and ``copies`` (landed copies)."""
    passes = "range(2)" if redelivery else "range(1)"
    return f"""ev as (
  select event_id, epoch_us(ts) as ts_us, {d.STREAM_OF_EVENT} as stream_type,
    {d.PREFIX_OF_EVENT} as key_prefix, {d.SYMBOL_OF_EVENT} as symbol, user_id, value
  from events),
spread as (select ev.*, unnest(range(7)) as s from ev),
kept as (select *, unnest({passes}) as redelivery from spread where {d.COPY_DELIVERED}),
copies as (
  select stream_type, symbol, event_id,
    concat(key_prefix, ':', cast(event_id as string)) as msg_key,
    {d.SOURCE_NAME} as source_id, {d.COPY_ARRIVAL} as arr_us, value,
    row_number() over (partition by stream_type, symbol
      order by {d.COPY_ARRIVAL}, event_id, s, redelivery) - 1 as seq_offset
  from kept where {d.COPY_REDELIVERED})"""


FIRSTS = f"""firsts as (
  select {K}, min(seq_offset) as first_offset, arg_min(source_id, seq_offset) as winner,
    arg_min(arr_us, seq_offset) as first_us
  from copies group by all)"""

ROSTER = f"""roster as (
  select {G}, source_id, min(seq_offset) as first_offset,
    arg_min(arr_us, seq_offset) as first_us, max(arr_us) as last_us
  from copies group by all)"""


def evicted(n: int, lag: int) -> str:
    return f"""per_source as (
  select {K}, source_id, min(seq_offset) as o, arg_min(arr_us, seq_offset) as at_us
  from copies group by all),
nth as (select *, row_number() over (partition by {K} order by o) as nth from per_source),
completing as (select {K}, o as complete_o, at_us as complete_us from nth where nth = {n}),
aged as (
  select *, row_number() over w as admitted_seq, lead(first_offset, {lag}) over w as stale_o,
    lead(first_us, {lag}) over w as stale_us
  from firsts window w as (partition by {G} order by first_offset)),
leaving as (
  select aged.*, complete_o, complete_us, least(complete_o, stale_o) as evict_offset,
    complete_o is not null and (stale_o is null or complete_o <= stale_o) as complete
  from aged left join completing using ({K})),
evicted as (
  select {K}, any_value(winner) as winner, any_value(first_offset) as first_offset,
    any_value(admitted_seq) as admitted_seq, any_value(evict_offset) as evict_offset,
    any_value(case when complete then complete_us else stale_us end) as evict_us,
    any_value(complete) as complete,
    count(distinct source_id) filter (where evict_offset is null or seq_offset <= evict_offset)
      as copies_seen,
    coalesce(max(seq_offset) > any_value(evict_offset), false) as late_copy
  from leaving join copies using ({K}) group by {K})"""


def gates(n: int) -> str:
    return f"""{ROSTER},
sightings as (select *, row_number() over (partition by {G} order by first_offset) as nth from roster),
gates as (
  select {G}, min(first_us) as started_us, max(case when nth = {n} then first_offset end) as open_offset,
    max(case when nth = {n} then first_us end) as open_us, max(last_us) as last_us
  from sightings group by all)"""


def tick(expr: str) -> str:
    return f"(({expr}) + (1000000::BIGINT - ({expr}) % 1000000) % 1000000)"


OBS_W = f"{int(OBSERVE.window_seconds)}::BIGINT * 1000000"
W1 = tick(f"open_us + {OBS_W}")


def window_of(at: str) -> str:
    return f"(case when {at} < {W1} then 0 else ({at} - {W1}) // ({OBS_W}) + 1 end)"


OBSERVED = f"""{feed(False)}, {FIRSTS}, {evicted(OBSERVE.expected_sources, OBSERVE.lag)},
{gates(OBSERVE.expected_sources)},
timed as (select *, {W1} as w1, {window_of('last_us')} as closed from gates where open_us is not null),
windows as (
  select {G}, k as window_no, case when k = 0 then open_us else w1 + (k - 1) * {OBS_W} end as window_start_us,
    w1 + k * {OBS_W} as window_end_us
  from (select *, unnest(range(closed)) as k from timed)),
credit as (
  select e.*, {window_of('evict_us')} as window_no, closed
  from evicted e join timed using ({G}) where evict_offset >= open_offset),
wins as (
  select w.stream_type, w.symbol, w.window_no, r.source_id, count(c.msg_key) as wins
  from windows w join roster r on r.stream_type = w.stream_type and r.symbol = w.symbol
    and r.first_us < w.window_end_us
  left join credit c on c.stream_type = w.stream_type and c.symbol = w.symbol
    and c.window_no = w.window_no and c.winner = r.source_id
  group by all)"""


def verdict_select(wins: str, keys: str, minimum: int) -> str:
    return f"""select {keys},
  case when n >= 2 and total >= {minimum} and at_low = 1 then slowest end as slowest_source_id,
  total::BIGINT as total_events, n as sources_seen,
  case when n < 2 then 'fewer than two sources contributed'
    when total < {minimum} then 'only ' || total || ' events, need {minimum}'
    when at_low > 1 then 'tie between ' || at_low || ' sources on ' || low || ' wins' end as reason
from (select {keys}, count(*) as n, sum(wins)::BIGINT as total, min(wins) as low,
    arg_min(source_id, wins) as slowest, count(*) filter (where wins = lowest) as at_low
  from (select *, min(wins) over (partition by {keys}) as lowest from {wins}) group by all)"""


SLOWEST = f"""with {feed()}, {FIRSTS}, {ROSTER},
wins as (select r.stream_type, r.symbol, r.source_id, count(f.msg_key) as wins
  from roster r left join firsts f on f.stream_type = r.stream_type and f.symbol = r.symbol
    and f.winner = r.source_id group by all)
{verdict_select('wins', G, 100)}"""


def arbitration_sql() -> dict[str, str]:
    n, lag = OBSERVE.expected_sources, OBSERVE.lag
    first_life = f"with {feed()}, {FIRSTS}, {evicted(n, lag)}"
    return {
        "slowest_source": SLOWEST,
        "arbitrated_feed": f"""with {feed()}, {FIRSTS}
select f.stream_type, f.symbol, f.msg_key, c.source_id, c.seq_offset, c.arr_us, c.value
from firsts f join copies c on c.stream_type = f.stream_type and c.symbol = f.symbol
  and c.seq_offset = f.first_offset""",
        "copy_classification": f"""with {feed()}
select {K}, source_id, seq_offset, case when seq_offset = min(seq_offset) over (partition by {K})
  then 'forwarded' else 'duplicate' end as outcome from copies""",
        "arrival_ranks": f"""with {feed()}
select {K}, source_id, seq_offset,
  row_number() over (partition by {K} order by seq_offset) as arrival_rank,
  seq_offset - min(seq_offset) over (partition by {K}) as lag_offsets from copies""",
        "arrival_lag_by_source": f"""with {feed()},
lagged as (select *, seq_offset - min(seq_offset) over (partition by {K}) as lag_o from copies)
select {G}, source_id, count(*) as copies, count(*) filter (where lag_o = 0) as firsts,
  sum(lag_o)::BIGINT as total_lag, max(lag_o) as max_lag from lagged group by all""",
        "copies_seen_per_key": f"""with {feed()}
select {K}, count(*) as copies, count(distinct source_id) as distinct_sources
from copies group by all""",
        "evictions": f"""{first_life}
select {K}, winner, first_offset, admitted_seq, evict_offset, evict_us, complete, copies_seen
from evicted""",
        "readmission_certificate": f"""{first_life}
select {G}, count(*) as keys, count(evict_offset) as evicted,
  count(*) filter (where complete) as completed,
  count(*) filter (where late_copy) as readmitted_keys from evicted group by all""",
        "pending_entries": f"""{first_life}
select {G}, count(*) filter (where evict_offset is null) as pending,
  min(first_offset) filter (where evict_offset is null) as oldest_offset
from evicted group by all""",
        "gate_opening": f"""with {feed()}, {gates(n)} select * from gates""",
        "observe_windows": f"with {OBSERVED} select * from windows",
        "window_wins": f"with {OBSERVED} select * from wins",
        "win_runs": f"""with {OBSERVED},
numbered as (select *, window_no - row_number() over (partition by {G}, source_id, wins = 0 order by window_no) as run
  from wins)
select {G}, source_id, min(window_no) as from_window, max(window_no) as to_window, wins from numbered
group by {G}, source_id, wins, run, case when wins > 0 then window_no end""",
        "window_verdicts": f"""with {OBSERVED},
told as ({verdict_select('wins', G + ', window_no', OBSERVE.minimum_events)})
select *, coalesce(window_no <= min(case when slowest_source_id is not null then window_no end)
  over (partition by {G}), true) as exact from told""",
        "running_tallies": f"""with {OBSERVED},
numbered as (select *, row_number() over (partition by {G}, window_no order by evict_offset) as n from credit),
snaps as (select {G}, window_no, n, evict_offset, evict_us from numbered where n % {OBSERVE.emit_tally_every} = 0)
select s.stream_type, s.symbol, s.window_no, (s.n - 1) // {OBSERVE.emit_tally_every} as tally_no,
  s.n as total_events, s.evict_us as emitted_us, r.source_id, count(c.msg_key) as wins
from snaps s join roster r on r.stream_type = s.stream_type and r.symbol = s.symbol
    and r.first_offset <= s.evict_offset
  left join numbered c on c.stream_type = s.stream_type and c.symbol = s.symbol
    and c.window_no = s.window_no and c.n <= s.n and c.winner = r.source_id
group by all""",
    }
