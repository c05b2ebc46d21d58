"""DuckDB SQL of the operators that SQL can express, written apart from them."""

from __future__ import annotations

TOP_K = """with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as i from rows),
scores as (
  select q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
  from parts q join parts c on q.i = c.i and q.vec_id <> c.vec_id where q.vec_id % 100 = 0 group by all),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scores)
select query_id, r::int as rank, vec_id, score from ranked where r <= 10"""

NEAR_VECTORS = """with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    and list_cosine_similarity(a.v, b.v) >= 0.98),
reached as (
  select vec_id as origin, vec_id as node from embeddings
  union select r.origin, l.b from reached r join links l on l.a = r.node),
least as (select origin, min(node) as component_id from reached group by origin),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n, 0)::bigint as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join least on origin = e.vec_id left join counts on a = e.vec_id"""


LEXICAL = r"""with split as (
  select doc_id, row_number() over () as d, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
asked as (
  select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
wanted as (select item_id, term, count(*) as q from asked group by all),
sizes as (select d, doc_id, len(t) as n from split where len(t) > 0),
totals as (select count(*) as docs, sum(n)::bigint as words from sizes),
tfs as (
  select d, term, count(*) as tf from (select d, unnest(t) as term from split)
  where term in (select term from wanted) group by all),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from tfs, totals group by term),
scores as (
  select item_id, doc_id, d, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::bigint as score
  from wanted join tfs using (term) join weights using (term) join sizes using (d), totals group by all)
select item_id, rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0)
where rank <= 10"""

REPAIR = r"""with recursive bytes as (
  select list(list_reduce([b::ubigint] || [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
    lambda c, x: xor(c >> 1, 3988292384::ubigint * (c & 1))) order by b) as t from range(256) as r(b)),
kinds as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce([4294967295]::ubigint[] || list_transform(
      string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::ubigint),
      lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::bigint])), 4294967295::ubigint) % 20 as kind
  from conversations, bytes),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as again
  from kinds where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), again) as i from damaged),
met as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth, left(role, 1) as initial,
    trim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) as core from placed),
faulty as (
  select *, case when core = '' then 'blank' when nth > 1 then 'duplicate'
    when right(core, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    i > 1 and concat(lag(initial) over (partition by conv_id order by i), initial) not in ('su', 'ua', 'au') as wrong from met),
told as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated, count(*) filter (where wrong) as illegal
  from faulty group by all),
inserts as (select * from (values
  ('', 0, ''), ('', 1, 'u'), ('', 2, 'ua'), ('s', 0, ''), ('s', 1, 'u'), ('s', 2, 'ua'),
  ('u', 0, ''), ('u', 1, 'a'), ('a', 0, ''), ('a', 1, 'u')) as v(st, k, added)),
paths as (
  select conv_id, 0::bigint as i, case when k = 0 then '' else right(added, 1) end as st, 5 * k as cost,
    repeat('I', k) as audit, case k when 1 then 'user:' when 2 then concat('user:', chr(10), 'assistant:') end as said
  from told, inserts where inserts.st = ''
  union all
  select conv_id, i, st, cost, audit, said from (
    select m.conv_id, m.i, case when k = 0 then m.st else right(added, 1) end as st, m.cost + 5 * k as cost,
      m.audit || repeat('I', k) as audit,
      nullif(concat_ws(chr(10), m.said, case left(added, 1) when 'u' then 'user:' when 'a' then 'assistant:' end,
        case substr(added, 2, 1) when 'a' then 'assistant:' end), '') as said,
      row_number() over (partition by m.conv_id, case when k = 0 then m.st else right(added, 1) end
        order by m.cost + 5 * k, m.audit || repeat('I', k)) as best
    from (
      select p.conv_id, f.i, case e when 'D' then p.st when 'K' then initial else new end as st,
        p.cost + case e when 'D' then 2 when 'R' then 1 else 0 end
          + case when fault = 'truncated' and e <> 'D' then 5 else 0 end as cost,
        p.audit || e as audit,
        case e when 'D' then p.said else concat_ws(chr(10), p.said, concat(
          case when e = 'K' then role when new = 'u' then 'user' else 'assistant' end, ':', text)) end as said
      from (select *, case when st = 'u' then 'a' else 'u' end as new from paths) p
      join faulty f on f.i = p.i + 1 and f.conv_id is not distinct from p.conv_id
      cross join (values ('D'), ('K'), ('R')) as edits(e)
      where e = 'D' or (fault not in ('blank', 'duplicate')
        and (e = 'R' or concat(p.st, initial) in ('s', 'u', 'su', 'ua', 'au')))) m
    join inserts on inserts.st = m.st) where best = 1),
ended as (
  select p.*, row_number() over (partition by p.conv_id order by cost, audit) as best
  from paths p join told on told.conv_id is not distinct from p.conv_id and n = i where st in ('', 'a'))
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join told t on t.conv_id is not distinct from c.conv_id
left join ended e on e.conv_id is not distinct from c.conv_id and best = 1"""


def oracle_sql() -> dict[str, str]:
    return {"op6_topk": TOP_K, "op9_embeddings": NEAR_VECTORS, "op11_lexical": LEXICAL, "op12_repair": REPAIR}
