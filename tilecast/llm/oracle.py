"""SQL twins, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
with sized as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         (('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':17'), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
  from documents
),
sizes as (
  select source, sum(size)::bigint as source_size,
         list_extract([3, 1, 2], ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int) as weight
  from sized group by source
),
full_at as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as lvl from sizes),
leveled as (
  select *, (1.5::double * (select coalesce(sum(size), 0) from sized)
             - coalesce(sum(cap) over (order by lvl, source rows between unbounded preceding and 1 preceding), 0.0))
            / sum(weight) over (order by lvl, source rows between current row and unbounded following) as own
  from full_at
),
goal as (
  select source, source_size,
         coalesce(least(cap, weight * (select own from leveled where own < lvl order by lvl, source limit 1)), cap)::double as target
  from leveled
),
plan as (
  select *, floor(case when source_size > 0 then target / source_size else 0.0 end) as certain,
         case when source_size > 0 then target / source_size else 0.0 end
         - floor(case when source_size > 0 then target / source_size else 0.0 end) as inclusion
  from goal
),
ranked as (
  select s.source, (u / (1.0::double - u)) / (inclusion / (1.0::double - inclusion)) as rnk, sum(size) as words,
         any_value(target - certain * source_size) as open
  from sized s join plan p on s.source is not distinct from p.source
  where inclusion > 0 group by s.source, rnk
),
running as (
  select *, coalesce(sum(words) over (partition by source order by rnk rows between unbounded preceding and 1 preceding), 0) as before
  from ranked
),
cuts as (select source, max(rnk) filter (where before + words / 2.0::double < open) as cut from running group by source)
select s.doc_id, s.size, p.source_size::bigint as source_size, p.target,
       ((certain + case when inclusion > 0 and (u / (1.0::double - u)) / (inclusion / (1.0::double - inclusion)) <= cut
                        then 1 else 0 end) * s.size)::bigint as taken
from sized s
join plan p on s.source is not distinct from p.source
left join cuts c on s.source is not distinct from c.source
"""

OP10 = r"""
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
terms as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as i from vectors),
scores as (
  select q.vec_id as query_id, c.vec_id as vec_id, sum(q.x * c.x)::bigint as score
  from terms q join terms c on q.i = c.i and q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0 group by all
),
placed as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores)
select query_id, rank, vec_id, score from placed where rank <= 5
"""


# CRC-32 by its table of 256 entries, from the polynomial 0xEDB88320.
OP11 = r"""
with crc as (
  select list(list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n) order by n) as entries
  from range(256) t(n)
),
texts as (
  select 0 as side, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
  union all
  select 1, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark
),
found as (
  select side, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words, row_number() over () as row from texts
),
word as (select side, row, unnest(words) as w from found),
hashed as materialized (
  select w, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x: ('0x' || x)::bigint),
                lambda c, b: xor(c >> 8, list_extract(entries, (xor(c, b) & 255) + 1)), 4294967295::bigint), 4294967295) % 10000 as bucket
  from (select distinct w from word), crc
),
counts as (
  select bucket, count(*) filter (side = 0)::double as s, count(*) filter (side = 1)::double as t
  from word join hashed using (w) group by bucket
),
gain as (
  select bucket,
         floor(1000 * ln((t + 1) * ((select sum(s) from counts) + 10000) / ((s + 1) * ((select sum(t) from counts) + 10000))))::bigint as gain
  from counts
),
weights as (
  select row, floor(sum(gain)::double / count(*))::bigint as weight
  from word join hashed using (w) join gain using (bucket) where side = 0 group by row
),
scored as (
  select doc_id, len(words)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from found left join weights using (row) where side = 0
),
placed as (
  select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id) end as place,
         count(*) filter (n_features >= 20) over () as n
  from scored
)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end::bigint as rank from placed
"""

# All pairs that share a shingle, and labels that sink along the links until none changes.
OP12 = r"""
with recursive words as (
  select doc_id, row_number() over () as row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select row, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words
),
shingles as materialized (select row, unnest(s) as x from sets),
common as (
  select a.row as a, b.row as b, count(*) as n from shingles a join shingles b on a.x = b.x and a.row < b.row group by all
),
links as materialized (
  select a, b from common join sets sa on sa.row = a join sets sb on sb.row = b where 100 * n >= 85 * (len(sa.s) + len(sb.s) - n)
),
edges as materialized (select a, b from links union all select b, a from links),
reach(a, b) as (
  select row, row from sets
  union
  select r.a, e.b from reach r join edges e on r.b = e.a
),
least as (select r.a as row, min(s.doc_id) as component_id from reach r join sets s on s.row = r.b group by r.a)
select doc_id, len(s)::bigint as n_shingles, component_id, coalesce(doc_id = component_id, false) as kept from sets join least using (row)
"""

OP13 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::hugeint as n from words group by lang),
sizes as (select unnest([1, 2, 3, 4, 5]) as size),
runs as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from words, sizes where len(w) >= size
),
counted as materialized (select lang, size, phrase, count(*)::hugeint as f from runs group by all having count(*) >= 100),
candidates as materialized (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counted where size >= 2),
cuts as (select *, unnest(range(1, size)) as k from candidates),
scored as (
  select c.lang, c.phrase, c.size, a, k, l.f as l, r.f as r, n, 1000 * a * n // (l.f * r.f) as score
  from cuts c join totals using (lang)
  join counted l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
  join counted r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ')
),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_runs as (
  select lang, a as around, unnest(list_transform(range(1, size - part + 2), lambda i: array_to_string(w[i:i + part - 1], ' '))) as phrase
  from candidates, (select unnest([2, 3, 4]) as part) where part < size
),
hidden as (select lang, phrase, max(around) as around from inner_runs group by all),
ranked as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join hidden h on h.lang = b.lang and h.phrase = b.phrase
  where h.around is null or 100 * h.around < 100 * a
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3, "op10_topk": OP10, "op11_importance": OP11, "op12_minhash": OP12, "op13_phrases": OP13}
