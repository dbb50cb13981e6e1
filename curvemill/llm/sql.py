"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_SIGNS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_BLANK = r"'[^\x20\x09-\x0D]+'"

NEAR = rf"""
with recursive d as (
  select doc_id, regexp_extract_all({_LOWER}, {_BLANK}) as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3),
                                      lambda i: array_to_string(w[i:i + 4], ' '))) end as s from d),
classes as (
  select min(doc_id) as node, any_value(len(s)) as n,
         any_value(s) as s from sets where len(s) > 0 group by list_sort(s)),
marks as (select node, n, unnest(s) as m from classes),
links as (
  select a.node as x, b.node as y from marks a join marks b on a.m = b.m and a.node < b.node
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
paths as (select x, y from links union all select y, x from links),
reach as (
  select node, node as low from classes
  union
  select paths.y as node, reach.low from reach join paths on paths.x = reach.node
  where reach.low < paths.y),
lows as (select node, min(low) as low from reach group by node)
select sets.doc_id, cast(len(sets.s) as bigint) as n_shingles,
  coalesce(lows.low, sets.doc_id) as component_id,
  sets.doc_id = coalesce(lows.low, sets.doc_id) as kept
from sets left join classes on len(sets.s) > 0 and list_sort(classes.s) = list_sort(sets.s)
left join lows on lows.node = classes.node
"""

LEAKS = rf"""
with d as (
  select doc_id, regexp_extract_all({_LOWER}, {_SIGNS}) as w from documents),
b as (
  select item_id, regexp_extract_all({_LOWER}, {_SIGNS}) as w from benchmark),
win as (
  select distinct item_id, array_to_string(w[i:i + 9], ' ') as g, least(len(w), 10) as k
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from b where len(w) > 0)),
sizes as (select distinct k from win),
places as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, sizes)),
found as (
  select p.doc_id, p.i, p.k, win.item_id from places p join win on p.g = win.g and p.k = win.k),
hit as (
  select doc_id, count(distinct j) as n_hit
  from (select doc_id, unnest(range(i, i + k)) as j from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as joined
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(joined, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""

QUALITY = rf"""
with d as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), {_BLANK}) as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, {_BLANK})) as lines
  from documents),
tri as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from tri)
  where c > 1),
repeated as (
  select doc_id, count(distinct j) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as j from twice) group by doc_id),
m as (
  select d.doc_id, host, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    len(lines) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words
  from d left join repeated using (doc_id)),
r as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    100 * n_symbols > 10 * word_chars or 100 * n_dup_lines > 30 * n_lines as soft_failed
  from m),
h as (
  select host, count(*) as n, count(*) filter (base_failed or soft_failed) as f
  from r group by host),
p as (
  select sum(f) / sum(n) as mean,
    sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) as spread
  from h),
s as (
  select mean, case when spread <= mean * (1 - mean) / 1000 then 1000.0
    else greatest(2.0, mean * (1 - mean) / spread - 1) end as strength from p),
v as (
  select host, (mean * strength + f) / (strength + n) as rate, strength + n + 1 as weight
  from h, s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not rate - 2 * sqrt(rate * (1 - rate) / weight) > 0.5
    and not (soft_failed and rate > 0.3) as kept
from r join v using (host)
"""

FIM = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || doc_id) as h,
    regexp_extract_all(coalesce(text, ''),
                       '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
  from documents),
c as (
  select *, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as x,
    cast('0x' || h[9:16] as bigint) % (len(u) + 1) as y,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
           or cast('0x' || h[17:24] as bigint) % 100 >= 50 then 'plain'
         when cast('0x' || h[25:32] as bigint) % 100 < 80 then 'spm' else 'psm' end as form
  from d),
p as (
  select *, array_to_string(u[1:least(x, y)], '') as prefix,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') as middle,
    array_to_string(u[greatest(x, y) + 1:n], '') as suffix from c)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from p
"""

WARC = """
with p as (
  select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h,
    min(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, cast(strlen(t) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + cast((cast('0x' || h[5 * (i // 4) + 1:5 * (i // 4) + 5] as bigint)
              >> cast(15 - 5 * (i % 4) as bigint)) & 31 as integer), 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from p
"""

NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as bigint)
      as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
pos as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select pos.anchor_id, positive_id, cast(row_number() over (
    partition by pos.anchor_id, positive_id order by score desc, other_id) as integer) as rank,
  other_id as negative_id, positive_score, score as negative_score
from pos join s on s.anchor_id = pos.anchor_id and not same
  and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""

SQL = {"op8_odd_sketch_dedup": NEAR, "op9_positional_decontamination": LEAKS,
       "op10_host_quality": QUALITY, "op11_seekable_fim": FIM, "op12_zstd_warc": WARC,
       "op13_segment_negatives": NEGATIVES}
