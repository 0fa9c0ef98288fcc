"""DuckDB forms of the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOPK = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, cast(r as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from s)
where r <= 20
"""

SUBSTRINGS = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select doc_id, i, md5(array_to_string(w[i:i+19], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
again as (
  select doc_id, i from (
    select doc_id, i, row_number() over (partition by h order by doc_id, i) as r from g)
  where r > 1),
gone as (select distinct doc_id, i + k as i from again, range(0, 20) t(k)),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from d),
kept as (
  select doc_id, count(gone.i) as n_removed,
         string_agg(case when gone.i is null then word end, ' ' order by words.i) as kept
  from words left join gone using (doc_id, i) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)
"""

DECONTAMINATE = rf"""
with fold as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
test as (
  select distinct item_id, n, array_to_string(w[i:i+n-1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from (select item_id, w, least(len(w), 13) as n from items where len(w) > 0))),
train as (
  select doc_id, n, i, array_to_string(w[i:i+n-1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from fold, (select distinct n from test) where len(w) >= n)),
hits as (select doc_id, i, n, item_id from train join test using (n, g)),
covered as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as place from hits) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from fold left join covered using (doc_id) left join named using (doc_id)
"""

AUDIT = r"""
with d as (
  select coalesce(lang, '') as part, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
firsts as (select t, min(doc_id) as first from d group by t),
marks as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good,
         coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         case when len(w) < 200 then 1 else 0 end as a,
         case when 100 * len(list_distinct(w)) < 50 * len(w) then 1 else 0 end as b,
         case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)
              then 1 else 0 end as c,
         case when regexp_matches(t, '[#$%&*|]') then 1 else 0 end as d,
         case when d.doc_id > first then 1 else 0 end as e
  from d join firsts using (t) left join marks on d.doc_id = marks.doc_id),
g as (
  select part, good, toxic, [a, b, c, d, e] as s,
         a + b + c + d + e as n_fails, count(*) as n
  from f group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select l1.x || l2.x || l3.x || l4.x || l5.x as o
  from letters l1, letters l2, letters l3, letters l4, letters l5
  where len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
steps as (select o, step, o[step] as x, o[1:step - 1] as before from orders, range(1, 6) r(step)),
r as (
  select g.*, o, step, s[instr('ABCDE', x)] = 1 as own,
         len(list_filter(string_split(before, ''), lambda y: y <> '' and s[instr('ABCDE', y)] = 1)) > 0 as gone
  from g, steps),
counts as (
  select part, o, step, o[step] as x,
         coalesce(sum(n) filter (not own and not gone), 0) as kept,
         coalesce(sum(n) filter (own and not gone), 0) as removed,
         coalesce(sum(n) filter (own and gone), 0) as redundant,
         coalesce(sum(n) filter (own and n_fails = 1), 0) as unique_fails,
         coalesce(sum(n) filter (own and not gone and good), 0) as good_lost,
         coalesce(sum(n) filter (own and not gone and toxic), 0) as toxic_lost
  from r group by part, o, step)
select part, o as filter_order, cast(step as integer) as step, cast(kept as bigint) as kept,
       cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
       cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, x) as bigint) as shapley
from counts
"""

ORACLES = {"op3_topk": TOPK, "op6_substrings": SUBSTRINGS, "op8_decontaminate": DECONTAMINATE,
           "op11_audit": AUDIT}
