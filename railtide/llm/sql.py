"""DuckDB SQL for the queries of this package that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op8_golomb_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

# Exponents are bisected in 30 halvings; each of the two targets has its own recursion.
ORACLE["op4_temperature_mixing"] = r"""
with recursive docs as (
  select doc_id, source, coalesce(source, '') as mix_source, coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) as key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 as n_tokens from documents),
sources as (
  select mix_source, sum(n_tokens)::bigint as tokens, count(*) as n_rows from docs group by all),
total as (select sum(tokens)::double as t, count(*) as k from sources),
shares as (select mix_source, tokens, n_rows, tokens / t as share from sources, total),
even(step, low, high) as (
  select 0, 0.0::double, 8.0::double
  union all
  select step + 1, case when low_entropy then low else mid end, case when low_entropy then mid else high end
  from (
    select step, low, high, mid,
      (select ln(sum(share ** mid)) - sum(share ** mid * ln(share ** mid)) / sum(share ** mid) from shares)
        < 0.97 * (select ln(k) from total) as low_entropy
    from (select *, (low + high) / 2 as mid from even where step < 30))),
limited(step, low, high) as (
  select 0, 0.0::double, 1.0::double
  union all
  select step + 1, case when enough then low else mid end, case when enough then mid else high end
  from (
    select step, low, high, mid,
      (select max(share ** mid / share) / sum(share ** mid) from shares) <= 4.0 as enough
    from (select *, (low + high) / 2 as mid from limited where step < 30))),
chosen as (
  select round(greatest((select low from even where step = 30), (select high from limited where step = 30)), 6) as exponent),
weighted as (
  select mix_source, tokens, n_rows, exponent,
    round(share ** exponent / (select sum(share ** exponent) from shares, chosen), 9) as weight from shares, chosen),
plan as (
  select *, floor(weight * (select t from total))::bigint as budget, ceil(n_rows / 4096.0)::bigint as blocks,
    floor(floor(weight * (select t from total)) / tokens)::int as passes from weighted),
cells as (
  select d.*, p.tokens, p.exponent, p.weight, p.budget, p.passes,
    ('0x' || substr(md5('17:' || key), 1, 8))::bigint % p.blocks as block
  from docs d join plan p using (mix_source)),
readings as (select *, unnest(range(passes + 1))::int as pass from cells),
drawn as (
  select *, coalesce(sum(n_tokens) over (partition by mix_source, pass, block
      order by md5('17:' || pass || ':' || key), doc_id, n_tokens
      rows between unbounded preceding and 1 preceding), 0) as before from readings),
blocks as (
  select mix_source, pass, block, row_number() over w - 1 as block_rank,
    coalesce(sum(size) over (w rows between unbounded preceding and 1 preceding), 0) as block_start
  from (select mix_source, pass, block, sum(n_tokens) as size from readings group by all)
  window w as (partition by mix_source, pass order by md5('17:' || pass || ':block:' || block)))
select doc_id, source, n_tokens::bigint as n_tokens, exponent, weight, budget, pass, block,
  block_rank::int as block_rank, (block_start + before)::bigint as start
from drawn join blocks using (mix_source, pass, block)
where pass < passes or block_start + before < budget - passes * tokens
"""

ORACLE["op9_url_lists"] = r"""
with hosts as (
  select *, nullif(regexp_replace(regexp_replace(regexp_replace(
      regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$', ''), '^www\.', ''), '') as host,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^?#]*)', 1) as path
  from pages),
names as (
  select distinct key from (
    select host as key from hosts
    union all
    select regexp_replace(host, '^[^.]*\.', '') from hosts where contains(regexp_replace(host, '^[^.]*\.', ''), '.'))
  where key is not null),
digits as (
  select key, ('0x' || substr(md5(key), 1, 1))::int as kind, ('0x' || substr(md5(key), 2, 4))::int % 400 as a,
    ('0x' || substr(md5(key), 6, 4))::int % 200 as b, ('0x' || substr(md5(key), 10, 4))::int % 150 as c,
    ('0x' || substr(md5(key), 14, 4))::int % 500 as d from names),
entries as (
  select 'block' as list, key, date '2023-07-01' + a as dated, 'add' as action from digits where kind < 4
  union all select 'block', key, date '2023-07-01' + (a + 10 + b), 'remove' from digits where kind < 4
  union all select 'block', key, date '2023-07-01' + (a + 10 + b + c), 'add' from digits where kind < 4
  union all select 'allow', key, date '2023-07-01' + d, 'add' from digits where kind in (4, 5)),
daily as (select list, key, dated, max(action) as action from entries group by all),
valid as (
  select list, key, dated as valid_from, valid_to from (
    select *, lead(dated) over (partition by list, key order by dated) as valid_to from daily) where action = 'add'),
captures as (
  select page_id, url, host, path, date '2024-01-01' + (page_id * 7919 % 366)::int as fetched,
    row_number() over () as rid from hosts),
labels as (select rid, string_split(host, '.') as labels from captures where host is not null and url is not null),
segments as (
  select rid, host, list_filter(string_split(path, '/'), lambda x: x <> '') as segments from captures
  where host is not null and url is not null),
keys as (
  select rid, array_to_string(labels[i:], '.') as key
  from (select rid, labels, unnest(range(1, greatest(len(labels), 2))) as i from labels)
  union
  select rid, host || '/' || array_to_string(segments[:i], '/')
  from (select rid, host, segments, unnest(range(1, len(segments) + 1)) as i from segments)),
hits as (
  select k.rid, v.*, count(*) over (partition by k.rid) as active, row_number() over (partition by k.rid
      order by length(v.key) desc, v.key, case when v.list = 'block' then 0 else 1 end, v.list) as place
  from keys k join captures c using (rid) join valid v on v.key = k.key
  where v.valid_from <= c.fetched and (v.valid_to is null or c.fetched < v.valid_to))
select c.page_id, c.url, c.fetched, c.host, coalesce(h.active, 0) as active, h.list as matched_list,
  h.key as matched_key, h.valid_from, h.valid_to, coalesce(h.list = 'block', false) as blocked
from captures c left join hits h on h.rid = c.rid and h.place = 1
"""

ORACLE["op11_filter_audit"] = r"""
with docs as (
  select d.doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1) as good,
    exists (select 1 from labels l where l.doc_id = d.doc_id and toxic = 1) as toxic
  from documents d),
failed as (
  select part, good, toxic,
    (case when len(words) < 200 then 1 else 0 end)
    + (case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end)
    + (case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) then 4 else 0 end)
    + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
    + (case when doc_id > min(doc_id) over (partition by text) then 16 else 0 end) as fails
  from docs),
cells as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e where a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps as (
  select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from orders, (select unnest(range(1, 6))::int as step)),
counted as (
  select part, filter_order, step, own,
    sum(n) filter (fails & (before | own) = 0) as kept,
    sum(n) filter (fails & own <> 0 and fails & before = 0) as removed,
    sum(n) filter (fails & own <> 0 and fails & before <> 0) as redundant,
    sum(n) filter (fails = own) as unique_fails,
    sum(good) filter (fails & own <> 0 and fails & before = 0) as good_lost,
    sum(toxic) filter (fails & own <> 0 and fails & before = 0) as toxic_lost
  from steps, cells group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley
from counted
"""

# All pairs of a label. Vectors are shorter than the limit of squares, so cosines need no scaling.
ORACLE["op12_vector_dedup"] = """
with recursive vectors as (
  select row_number() over () as place, vec_id, label, embedding::double[] as v,
    label is not null and embedding is not null and len(embedding) > 0
    and list_count(embedding) = len(embedding)
    and coalesce(list_bool_and([isfinite(x) for x in embedding]), false)
    and coalesce(list_bool_or([x <> 0 for x in embedding]), false) as usable
  from embeddings),
links as (
  select a.place as a, b.place as b from vectors a join vectors b
  on a.label = b.label and a.place <> b.place and a.usable and b.usable and len(a.v) = len(b.v)
    and list_cosine_similarity(a.v, b.v) >= 0.98),
reached as (
  select place as a, place as b from vectors
  union
  select r.a, l.b from reached r join links l on r.b = l.a),
least as (
  select r.a as place, min(v.vec_id) as component_id from reached r join vectors v on v.place = r.b group by all)
select v.vec_id, (select count(*) from links where a = v.place) as n_links, component_id,
  coalesce(v.vec_id = component_id, false) as kept
from vectors v join least using (place)
"""
