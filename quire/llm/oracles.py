"""DuckDB SQL for the queries that SQL can express.

The learned and tokenizer queries (2, 3, 6, 7, 9) and the pipeline have none;
``tests/llm`` holds them against brute-force versions.
"""

from __future__ import annotations

import string

GAP = r"'[\x20\x09-\x0D]+'"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {GAP}), lambda x: x <> '')"

#: The rules' votes, written by hand in the order of ``quality_rules.RULES``.
VOTES = (
    "case when n_words < 10 then -1 when n_words >= 30 then 1 else 0 end",
    "case when 100.0 * n_repeat_words / nullif(n_words, 0) > 20 then -1 when 100.0 * n_repeat_words / nullif(n_words, 0) <= 1 then 1 else 0 end",
    "case when 100.0 * n_symbols / nullif(word_chars, 0) > 3 then -1 when 100.0 * n_symbols / nullif(word_chars, 0) <= 0.2 then 1 else 0 end",
    "case when 100.0 * n_capitals / nullif(word_chars, 0) > 20 then -1 "
    "when 100.0 * n_capitals / nullif(word_chars, 0) between 0.2 and 8 then 1 else 0 end",
    "case when n_words < 20 then 0 when 100.0 * n_stops / n_words < 1 or 100.0 * n_stops / n_words > 50 then -1 "
    "when 100.0 * n_stops / n_words between 2 and 25 then 1 else 0 end",
    "case when n_words < 40 then 0 when 100.0 * n_commas / n_words < 0.5 or 100.0 * n_commas / n_words > 40 then -1 "
    "when 100.0 * n_commas / n_words between 1 and 15 then 1 else 0 end",
    "case when 1.0 * word_chars / nullif(n_words, 0) < 3 or 1.0 * word_chars / nullif(n_words, 0) > 14 then -1 "
    "when 1.0 * word_chars / nullif(n_words, 0) between 4 and 9 then 1 else 0 end",
    "case when n_words not between 20 and 2000 then 0 when 100.0 * n_distinct / n_words < 20 then -1 "
    "when 100.0 * n_distinct / n_words >= 45 then 1 else 0 end",
    "case when n_lines < 3 then 0 when 100.0 * n_dup_lines / n_lines > 30 then -1 when 100.0 * n_dup_lines / n_lines <= 5 then 1 else 0 end",
    "case when 100.0 * n_shouts / nullif(n_words, 0) > 15 then -1 else 0 end",
    "case when 100.0 * n_same / nullif(n_words, 0) > 10 then -1 else 0 end",
    "case when 100.0 * n_plain / nullif(n_words, 0) < 60 then -1 when 100.0 * n_plain / nullif(n_words, 0) >= 85 then 1 else 0 end",
    "case when 100.0 * n_lone / nullif(n_words, 0) > 8 then -1 else 0 end",
    "case when 100.0 * n_odd_ends / nullif(n_words, 0) > 15 then -1 when 100.0 * n_odd_ends / nullif(n_words, 0) <= 3 then 1 else 0 end",
)


def quality_rules(rounds: int = 30) -> str:
    m = len(VOTES)
    good, bad = "0.02, 0.38, 0.6", "0.3, 0.3, 0.4"
    cells = f"select unnest(range({3 * m})) as k"
    terms = " + ".join(f"ln(bad[{3 * j + 2} + v[{j + 1}]]) - ln(good[{3 * j + 2} + v[{j + 1}]])" for j in range(m))
    q = f"1 / (1 + exp(ln((1 - share) / share) + {terms}))"
    steps = [f"e0 as materialized (select [{', '.join([good] * m)}]::double[] as good, [{', '.join([bad] * m)}]::double[] as bad, 0.8::double as share)"]
    for r in range(rounds):
        steps.append(f"p{r} as materialized (select id, v, n, n * {q} as q from pat, e{r})")
        steps.append(f"""
t{r} as materialized (select coalesce(sum(q), 0) as q, coalesce(sum(n), 0) as n from p{r}),
e{r + 1} as materialized (
  select list((s.q + 10 * e0.good[k + 1]) / (t.q + 10) order by k) as good,
         list((s.n - s.q + 10 * e0.bad[k + 1]) / (t.n - t.q + 10) order by k) as bad, (any_value(t.q) + 8.0) / (any_value(t.n) + 10.0) as share
  from (select cells.k, coalesce(sum(p.q), 0) as q, coalesce(sum(p.n), 0) as n
        from cells left join said on said.k = cells.k left join p{r} p on p.id = said.id group by cells.k) s, t{r} t, e0)""")
    return rf"""
with d as (
  select row_number() over () as row, doc_id, coalesce(text, '') as t, {WORDS} as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) as ls
  from documents),
win as (
  select row, i, array_to_string(ws[i:i + 4], ' ') as w
  from (select row, ws, unnest(range(1, len(ws) - 3)) as i from d)),
rep as (select row, i from win where (row, w) in (select (row, w) from win group by row, w having count(*) > 1)),
covered as (select row, count(distinct p) as n from (select row, unnest(range(i, i + 5)) as p from rep) group by row),
f as (
  select d.row, doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g')) as n_shouts,
         length(regexp_replace(t, '[^.]', '', 'g')) as n_stops, length(regexp_replace(t, '[^,]', '', 'g')) as n_commas,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_capitals, len(list_distinct(ws)) as n_distinct,
         len(list_filter(ws, lambda x: regexp_matches(x, '^\p{{L}}+[.,;:!?]?$'))) as n_plain,
         len(list_filter(ws, lambda x: regexp_matches(x, '^[^\p{{L}}\p{{N}}]+$'))) as n_lone,
         len(list_filter(ws, lambda x: regexp_matches(x, '^\p{{L}}(?s:.)*[^\p{{L}}]{{2}}$'))) as n_odd_ends,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, len(ls) as n_lines,
         coalesce(c.n, 0) as n_repeat_words,
         len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) as n_same
  from d left join covered c on c.row = d.row),
v as (select *, [{', '.join(VOTES)}] as v from f),
pat as materialized (select row_number() over () as id, v, n from (select v, count(*)::double as n from v group by v)),
cells as materialized ({cells}),
said as materialized (select id, 3 * (j - 1) + v[j] + 1 as k from (select id, v, unnest(range(1, {m + 1})) as j from pat)),
{', '.join(steps)}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and round({q}, 9) >= 0.5 as kept
from (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from v), e{rounds}"""


TOPK = """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as c from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.row, q.vec_id as query_id, o.vec_id, list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * o.c[i]))::bigint as score
  from v q join v o on o.row <> q.row where q.vec_id % 20 = 0)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by row order by score desc, vec_id) as rank from s) where rank <= 20"""

MIX = rf"""
with d as (
  select row_number() over () as row, doc_id, source, len({WORDS})::bigint as size from documents),
src as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as pos,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
  from d group by source),
c as (
  select *, 3 * source_size as cap, sum(source_size) over () as total,
         sum(source_size) over () - coalesce(sum(3 * source_size) over (
           order by source_size::double / w, pos rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(w) over () - coalesce(sum(w) over (
           order by source_size::double / w, pos rows between unbounded preceding and 1 preceding), 0) as w_rest
  from src),
r as (
  select rest::double / w_rest as rate from c where cap >= rest::double / w_rest * w
  order by source_size::double / w, pos limit 1),
t as (
  select c.*, least(cap::double, coalesce((select rate from r) * w, cap::double)) as target from c),
b as (
  select *, greatest((source_size + 31) // 32, least(source_size, 16)) as n_blocks from t),
n as (
  select *, source_size // greatest(n_blocks, 1) as base, source_size % greatest(n_blocks, 1) as extra,
         case when source_size > 0 then floor(target * n_blocks / source_size + 0.5)::bigint else 0 end as slots
  from b),
h as (
  select *, sum(slots) over () as all_slots,
         case when sum(slots) over () > 0 then round((sum(slots) over (order by pos))::double / (sum(slots) over ())::double * 2147483648)::bigint
              else 0 end as hi
  from n),
share as (select *, coalesce(lag(hi) over (order by pos), 0) as lo from h),
slot as (
  select i, ((i + 1) % 2147483648) * 1327217885 % 2147483648 as x
  from range(0, coalesce((select max(all_slots) from share), 0)::bigint) as g(i)),
ranked as (
  select pos, n_blocks, slots, row_number() over (partition by pos order by i) as rank from slot join share on x >= lo and x < hi),
settled as (
  select pos, n_blocks, rank from ranked where rank <= slots
  union all
  select pos, n_blocks, unnest(range(had + 1, slots + 1)) from (
    select share.pos, share.n_blocks, share.slots, count(ranked.pos) as had
    from share left join ranked using (pos) group by all) where had < slots),
times as (
  select pos, (rank - 1) % n_blocks as block, count(*) as times from settled group by all),
place as (
  select row, doc_id, size, pos, base, extra, coalesce(sum(size) over (
           partition by pos order by md5(coalesce(doc_id::varchar, '')), doc_id nulls first, size
           rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join share on d.source is not distinct from share.source where size > 0),
piece as (
  select row, pos, block, least(start + size, (block + 1) * base + least(block + 1, extra))
                          - greatest(start, block * base + least(block, extra)) as part
  from (select *, unnest(range(
          case when start < extra * (base + 1) then start // (base + 1) else extra + (start - extra * (base + 1)) // base end,
          case when start + size - 1 < extra * (base + 1) then (start + size - 1) // (base + 1)
               else extra + (start + size - 1 - extra * (base + 1)) // base end + 1)) as block from place)),
taken as (
  select row, sum(part * coalesce(times, 0))::bigint as taken from piece left join times using (pos, block) group by row)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken
from d join share on d.source is not distinct from share.source left join taken using (row)"""

JACCARD = rf"""
with recursive d as (
  select row_number() over () as row, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                           {GAP}), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct row, unnest(case when len(ws) = 0 then []::varchar[] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as w
  from d),
n as (select row, count(*) as n from s group by row),
both_in as (select a.row as a, b.row as b, count(*) as k from s a join s b on a.w = b.w and a.row < b.row group by all),
link as (
  select a, b from both_in join n x on x.row = a join n y on y.row = b where 100 * k >= 80 * (x.n + y.n - k)),
edge as (select a, b from link union all select b, a from link),
reach(row, other) as (
  select row, row from d union select reach.row, edge.b from reach join edge on edge.a = reach.other)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id
from d left join n on n.row = d.row
join (select reach.row, min(o.doc_id) as component_id from reach join d o on o.row = reach.other group by reach.row) m
  on m.row = d.row"""


def warc() -> str:
    host = (r"regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), ':(80|443)$', '')")
    path = r"regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1)"
    fields = (r"list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), "
              r"lambda x: x <> '' and not starts_with(x, 'utm_')))")

    def lines(cache, length, date, etag, modified):
        parts = [("cache-control", cache), ("content-length", length), ("date", date), ("etag", etag),
                 ("last-modified", modified)]
        return ("array_to_string(list_filter([" + ", ".join(f"'{k}: ' || {v}" for k, v in parts)
                + "], lambda x: x is not null), chr(10))")
    return rf"""
with p as (
  select page_id, url, md5(coalesce(html, '')) as tag, length(html) as n, unnest([0, 1, 2, 3]) as c from pages),
r as (
  select page_id * 4 + c as record_id, c, page_id, n, tag,
         c = 0 or c = 3 and page_id % 4 = 0 as is_full,
         case when c = 1 then regexp_replace(url, '#.*$', '') || '#again' else url end as url,
         page_id * 7 + case when c < 3 then c * 86400 when page_id % 4 = 0 then 259200 else -100000 end as ts
  from p),
h as (
  select *, regexp_replace(trim(url), '#.*$', '') as u,
         case when c = 0 then '"' || tag || '"' when is_full then '"' || tag || '-2"'
              when c = 2 and page_id % 5 = 0 then '"other"' when c = 2 and page_id % 5 in (1, 2) then null
              when page_id % 3 = 0 then 'W/"' || tag || '"' else '"' || tag || '"' end as etag,
         case when c = 2 and page_id % 5 = 2 then null else 'day ' || page_id % 100 end as modified,
         'max-age=' || c * 60 as cache, (case when is_full then n else 0 end)::varchar as length, 't' || c as date
  from r),
k as (
  select *, {host} || case when {path} = '' then '/' else {path} end
         || case when len({fields}) > 0 then '?' || array_to_string({fields}, '&') else '' end as key
  from h),
a as (
  select *, last_value(case when is_full then record_id end ignore nulls) over (
           partition by key order by ts, record_id rows between unbounded preceding and 1 preceding) as found
  from k),
j as (
  select a.*, f.record_id as response_id, f.etag as f_etag, f.modified as f_modified, f.length as f_length,
         coalesce(regexp_replace(a.etag, '^W/', '') = regexp_replace(f.etag, '^W/', ''), a.modified = f.modified) as agree
  from a left join k f on f.record_id = a.found and a.key is not null
  where not a.is_full)
select record_id, key as url_key,
       case when response_id is null then 'missing' when agree is null then 'unproven'
            when agree then 'resolved' else 'conflict' end as resolution,
       response_id, case when response_id is not null and agree then 200 else 304 end as status,
       case when response_id is not null and agree
            then {lines('cache', 'f_length', 'date', 'coalesce(etag, f_etag)', 'f_modified')}
            else {lines('cache', 'length', 'date', 'etag', 'modified')} end as headers
from j"""


def cover_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = []
    for r in range(rounds + 1):
        # nearest entry, ties to the lower one: distance * 1000 + entry is least
        steps.append(f"""
a{r} as materialized (
  select row, part, min(d * 1000 + entry) as m
  from (select p.row, p.part, b.entry, sum((p.x - b.y) * (p.x - b.y))::hugeint as d
        from p join b{r} b on b.part = p.part and b.pos = p.pos group by all)
  group by row, part)""")
        if r < rounds:
            steps.append(f"""
b{r + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce(c.y, b.y) as y
  from b{r} b left join (
    select a.part, (a.m % 1000)::int as entry, p.pos, floor(sum(p.x) / count(*))::bigint as y
    from a{r} a join p on p.row = a.row and p.part = a.part group by all) c using (part, entry, pos))""")
    return f"""
with v as (
  select row_number() over () as row, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as c
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
w as (select ceil(max(len(c)) / {parts})::bigint as w from v),
p as materialized (
  select row, k // w as part, k % w as pos, coalesce(c[k + 1], 0) as x from (select row, c, w, unnest(range({parts} * w)) as k from v, w)),
b0 as materialized (
  select p.part, f.entry, p.pos, p.x as y
  from (select row, row_number() over (order by vec_id nulls last, c) - 1 as entry from v order by entry limit {entries}) f
  join p using (row)),{",".join(steps)},
hash as (select sha256(string_agg(y::varchar, ',' order by part, entry, pos)) as h from b{rounds}),
coded as (
  select row, string_agg(printf('%02x', (m % 1000)::int), '' order by part) as code, sum(m // 1000)::bigint as error
  from a{rounds} group by row)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h as codebooks_sha256
from coded join v using (row), hash"""


CHAT = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, false as added from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]', true
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', true),
e as (
  select *, regexp_replace(role, '([<\[])(~*(?:/?s>|/?INST\]|(?:image|audio|document|other)>))', '\1~\2', 'g') as er,
         regexp_replace(text, '([<\[])(~*(?:/?s>|/?INST\]|(?:image|audio|document|other)>))', '\1~\2', 'g') as ec
  from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, ec)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, ec) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('<s>') + length(er) + length('[INST]') + length(ec) + length('[/INST]</s>'))::bigint as formatted_chars
from e group by conv_id, added"""


RESAMPLING = rf"""
with tab as materialized (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
w as materialized (
  select of, row, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from (select 'd' as of, row_number() over () as row, text from documents
        union all select 't', 0, text from benchmark)),
hex as (select word, hex(encode(word)) as h from (select distinct word from w)),
crc as materialized (
  select word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i:
    (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 as bucket
  from hex, tab),
n as (select bucket, count(*) filter (where of = 'd') as s, count(*) filter (where of = 't') as t from w join crc using (word) group by bucket),
gain as (
  select bucket, floor(1000 * ln(((t + 1)::double * (ss + 10000)::double) / ((s + 1)::double * (tt + 10000)::double)))::bigint as g
  from n, (select sum(s) as ss, sum(t) as tt from n)),
weight as (
  select row, count(*) as n, floor(sum(g)::double / count(*))::bigint as weight
  from w join crc using (word) join gain using (bucket) where of = 'd' group by row),
h as (
  select row_number() over () as row, doc_id, list_reduce(list_prepend(0, list_transform(range(1, 9), lambda i:
    strpos('0123456789abcdef', sha256('2024:' || coalesce(doc_id::varchar, ''))[i]) - 1)), lambda a, d: a * 16 + d) as h
  from documents),
scored as (
  select row, doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score
  from h left join weight using (row)),
ranked as (
  select row, row_number() over (order by score desc, doc_id nulls last, n_features) as rank,
         10 * count(*) over () // 100 as take
  from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= take then rank end as rank
from scored left join ranked using (row)"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules(),
    "op4_exact_topk": TOPK,
    "op5_source_mix": MIX,
    "op8_jaccard_join": JACCARD,
    "op10_warc_revisits": warc(),
    "op11_cover_codes": cover_codes(),
    "op12_chat_parts": CHAT,
    "op13_target_resampling": RESAMPLING,
}
