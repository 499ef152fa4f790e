"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from tillspark.llm.mixing import EPOCHS, SHARE_PERCENT, WEIGHTS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = f"""
with docs as (select doc_id, row_number() over () as r, {_WORDS} as ws from documents),
starts as (
  select r, doc_id, ws, unnest(range(1, len(ws) - 11)) as i from docs where len(ws) >= 13),
wins as (select r, doc_id, i, array_to_string(ws[i:i + 12], ' ') as w from starts),
first as (select w, min(doc_id) as d from wins group by w),
gone as (
  select distinct r, unnest(range(i, i + 13)) as p from wins join first using (w)
  where d < doc_id or (doc_id is null and d is not null)),
dropped as (select r, list(p) as ps from gone group by r)
select doc_id, len(ws) as n_words, len(coalesce(ps, [])) as n_removed,
  sha256(array_to_string(
    [ws[k] for k in range(1, len(ws) + 1) if not list_contains(coalesce(ps, []), k)], ' '))
    as kept_sha256
from docs left join dropped using (r)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEST_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
with docs as (select doc_id, row_number() over () as r, {_TEST_WORDS} as ws from documents),
items as (
  select coalesce(cast(item_id as varchar), '') as item, {_TEST_WORDS} as ws from benchmark),
wins as (
  select distinct item, least(len(ws), 10) as n,
    array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as w
  from (select item, ws, unnest(range(1, greatest(len(ws) - 8, 2))) as i
        from items where len(ws) > 0)),
sizes as (select distinct n from wins),
starts as (
  select r, n, i, array_to_string(ws[i:i + n - 1], ' ') as w
  from (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as i
        from docs, sizes where len(ws) >= n)),
hits as (select r, i, n, item from starts join wins using (n, w)),
words as (select r, count(distinct p) as n_hit
          from (select r, unnest(range(i, i + n)) as p from hits) group by r),
found as (select r, count(distinct item) as n_items,
            array_to_string(list_sort(list(distinct item)), ',') as items
          from hits group by r)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)
"""

MIXING = f"""
with docs as (
  select doc_id, source, row_number() over () as r, len({_WORDS}) as size,
    md5(coalesce(cast(doc_id as varchar), '')) as draw
  from documents),
sources as (
  select source, sum(size)::hugeint as source_size,
    [{", ".join(map(str, WEIGHTS))}][
      1 + (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)}] as weight
  from docs group by source),
caps as (select *, source_size * {EPOCHS} as most from sources),
filling as (
  select *, sum(source_size) over () as total,
    coalesce(sum(most) over (order by most::double / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as filled,
    sum(weight) over (order by most::double / weight, source nulls last
      rows between current row and unbounded following) as open_weight
  from caps),
closed as (
  select *, (filled * weight + most * open_weight) * 100 <= total * weight * {SHARE_PERCENT} as capped
  from filling),
targets as (
  select source, source_size, case when capped then most::double else
      weight::double * ((total::double * ({SHARE_PERCENT} / 100.0::double)
        - coalesce(sum(case when capped then most end) over (), 0)::double)
        / sum(case when not capped then weight end) over ()::double) end as target
  from closed),
sent as (
  select d.*, source_size, target,
    sum(size) over (partition by d.source order by draw, doc_id, size, r
      rows between unbounded preceding and current row) as sent
  from docs d join targets t on d.source is not distinct from t.source),
copies as (
  select r, source, draw, doc_id, size, e, (sent + e * source_size)::double / target as finish
  from sent, range({EPOCHS}) as epochs(e) where size > 0),
queued as (
  select r, size, sum(size) over (order by finish, source nulls last, e, draw, doc_id, r
    rows between unbounded preceding and current row) as reached
  from copies),
budget as (
  select floor(sum(source_size) * {SHARE_PERCENT} / 100.0)::bigint as budget from sources),
taken as (
  select r, sum(greatest(0, least(size, budget - (reached - size)))) as taken
  from queued, budget group by r)
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
  coalesce(taken, 0)::bigint as taken
from sent left join taken using (r)
"""

WARC = """
with p as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest
  from pages),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by all)
select page_id, payload_bytes, payload_digest,
  case when page_id > first or (page_id is null and first is not null) then 'revisit'
    else 'response' end as record_type,
  case when page_id > first or (page_id is null and first is not null) then first end as refers_to
from p left join f using (payload_digest)
"""

RUNS = f"""
with recursive eighths as (
  select k, k as c, 0 as step from range(256) bytes(k)
  union all
  select k, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1
  from eighths where step < 8),
crc as (select list(c order by k) as crcs from eighths where step = 8),
plain as (
  select row_number() over () as r, doc_id, {_WORDS} as ws,
    case when doc_id is not null then xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(
        string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint)),
      lambda a, x: xor(a >> 8, crcs[1 + xor(a & 255, x)])), 4294967295::bigint) end as h
  from documents, crc),
placed as (
  select *, len(ws) as n, h // 10 as g,
    case when h % 10 = 0 and len(ws) > 0 then (h // 10) % len(ws) end as a
  from plain),
sized as (select *, 1 + (n - a) // (3 + g % 8) as p from placed),
docs as (
  select r, doc_id, case when a is null then ws else
    [ws[case when i < a then i + 1 else a + (i - a) % p + 1 end] for i in range(n)] end as ws
  from sized),
words as (select r, unnest(ws) as w, unnest(range(len(ws))) as i from docs),
equal as (
  select x.r, y.i - x.i as q, x.i from words x join words y on x.r = y.r and x.w = y.w and x.i < y.i),
islands as (
  select r, q, i, i - row_number() over (partition by r, q order by i) as island from equal),
stretches as (
  select r, q, min(i) as s, count(*) + q as size from islands group by r, q, island
  having count(*) >= q),
runs as (
  select r, s, size, min(q) as q from stretches where size >= 12 group by r, s, size),
gone as (select distinct r, unnest(range(s + q, s + size)) as i from runs),
kept as (
  select r, string_agg(w, ' ' order by i) as kept
  from words anti join gone using (r, i) group by r),
found as (
  select r, count(*) as n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' order by s, q) as runs,
    list({{'start': s, 'length': size, 'period': q}} order by size desc, s, q)[1] as longest
  from runs group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, longest.start as start, longest.length as length,
  longest.period as period, 1000 * longest.length // longest.period as exponent_milli,
  sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from docs left join found using (r) left join kept using (r)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_JACCARD_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

JACCARD = f"""
with recursive docs as (
  select row_number() over () as r, doc_id, {_JACCARD_WORDS} as ws from documents),
sets as (
  select r, doc_id, list_distinct(
    [array_to_string(ws[i:i + 4], ' ') for i in range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))])
    as gs
  from docs),
grams as (select r, unnest(gs) as g from sets),
pairs as (
  select x.r as x, y.r as y, count(*) as shared
  from grams x join grams y on x.g = y.g and x.r <> y.r group by all),
linked as (
  select x, y from pairs join sets a on a.r = x join sets b on b.r = y
  where 100 * shared >= 80 * (len(a.gs) + len(b.gs) - shared)),
reached as (select r as x, r as y from sets union select l.x, m.y from linked l join reached m on l.y = m.x)
select s.doc_id, len(s.gs) as n_shingles, min(t.doc_id) as component_id
from sets s join reached on s.r = x join sets t on t.r = y group by s.r, s.doc_id, s.gs
"""

SEARCH = f"""
with docs as (select doc_id, row_number() over () as r, {_TERMS} as ts from documents),
total as (
  select count(*) filter (len(ts) > 0) as n_docs, sum(len(ts))::hugeint as n_terms from docs),
held as (select r, t, count(*) as tf from (select r, unnest(ts) as t from docs) group by all),
seen as (select t, count(*) as df from held group by t),
items as (select item_id, row_number() over () as q, {_TERMS} as ts from benchmark),
asked as (select q, t, count(*) as times from (select q, unnest(ts) as t from items) group by all),
weights as (
  select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::hugeint as w
  from seen, total),
sizes as (
  select r, doc_id, 100 - 25 + ((25 * len(ts)::hugeint * n_docs) // n_terms) as m from docs, total
  where len(ts) > 0),
scored as (
  select q, r, doc_id,
    sum(times * w * ((1000000000::hugeint * tf) // (1000 * tf + 12 * m)))::bigint as score
  from asked join weights using (t) join held using (t) join sizes using (r)
  group by all),
ranked as (
  select *, row_number() over (partition by q order by score desc, doc_id nulls last) as rank
  from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked join items using (q) where rank <= 20
"""

ORACLE: dict[str, str] = {
    "op3_substring_dedup": SUBSTRINGS,
    "op8_decontamination": DECONTAMINATION,
    "op9_mixing": MIXING,
    "op10_warc": WARC,
    "op11_periodic_runs": RUNS,
    "op12_jaccard_join": JACCARD,
    "op13_ranked_search": SEARCH,
}
