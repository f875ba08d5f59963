"""DuckDB SQL for the queries that SQL can express on whole tables, written apart from the operators."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FILTER_AUDIT = r"""
with texts as (
    select d.doc_id, coalesce(d.lang, '') as part, coalesce(d.text, '') as text,
        regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') as words,
        min(d.doc_id) over (partition by coalesce(d.text, '')) as first_id
    from documents d),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
failed as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        case when len(words) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
        || case when 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) then 'C' else '' end
        || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
        || case when t.doc_id > first_id or (t.doc_id is null and first_id is not null) then 'E' else '' end as fails
    from texts t left join marks m on t.doc_id = m.doc_id),
kinds as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
    where a.x not in (b.x, c.x, d.x, e.x) and b.x not in (c.x, d.x, e.x) and c.x not in (d.x, e.x) and d.x <> e.x),
steps as (
    select filter_order, step::int as step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
counted as (
    select part, filter_order, step, own,
        sum(case when translate(fails, before || own, '') = fails then n else 0 end)::bigint as kept,
        sum(case when contains(fails, own) and translate(fails, before, '') = fails then n else 0 end)::bigint as removed,
        sum(case when contains(fails, own) and translate(fails, before, '') <> fails then n else 0 end)::bigint as redundant,
        sum(case when fails = own then n else 0 end)::bigint as unique_fails,
        sum(case when contains(fails, own) and translate(fails, before, '') = fails then good else 0 end)::bigint as good_lost,
        sum(case when contains(fails, own) and translate(fails, before, '') = fails then toxic else 0 end)::bigint as toxic_lost
    from kinds, steps group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, own))::bigint as shapley
from counted
"""

_COLLOCATIONS = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
starts as (select lang, ws, unnest(generate_series(1, len(ws))) as i from split),
grams as (
    select lang, n, array_to_string(ws[i:i + n - 1], ' ') as phrase, count(*)::bigint as f
    from starts, (select unnest([1, 2, 3]) as n) where i + n - 1 <= len(ws) group by all),
sizes as (select lang, sum(f)::bigint as n from grams where n = 1 group by lang),
found as (select lang, n, phrase, f as a, string_split(phrase, ' ') as ws from grams where n > 1 and f >= 10),
cuts as (
    select c.lang, c.phrase, c.a, c.n as words, k, l.f as l, r.f as r, ((1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f))::bigint as score
    from (select *, unnest(generate_series(1, n - 1)) as k from found) c
    join grams l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1:k], ' ') and l.n = k
    join grams r on r.lang = c.lang and r.phrase = array_to_string(c.ws[k + 1:c.n], ' ') and r.n = c.n - k),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select lang, array_to_string(ws[1:2], ' ') as phrase, a from found where n = 3
    union all select lang, array_to_string(ws[2:3], ' '), a from found where n = 3),
kept as (select * from best b where not exists (select 1 from inside i where i.lang = b.lang and i.phrase = b.phrase and 100 * i.a >= 50 * b.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank::int as rank, r.phrase, r.a, r.l, r.r, s.n, r.score from ranked r join sizes s on s.lang = r.lang where r.rank <= 2000
"""

_DECONTAMINATION = rf"""
with items as (
    select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from benchmark),
item_windows as (
    select distinct item, least(len(ws), 10) as k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as win
    from (select item, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) as i from items where len(ws) > 0)),
docs as (
    select row_number() over () as doc_row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from documents),
starts as (select doc_row, ws, unnest(generate_series(1, len(ws))) as i from docs),
doc_windows as (
    select doc_row, i, k, array_to_string(ws[i:i + k - 1], ' ') as win
    from starts, (select distinct k from item_windows) where i + k - 1 <= len(ws)),
found as (select d.doc_row, d.i, d.k, w.item from doc_windows d join item_windows w on w.k = d.k and w.win = d.win),
hits as (select doc_row, count(distinct p) as n_hit from (select distinct doc_row, unnest(generate_series(i, i + k - 1)) as p from found) group by doc_row),
named as (select doc_row, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_row, item from found) group by doc_row)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(n.n_items, 0)::bigint as n_items,
    sha256(coalesce(n.names, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hits h on h.doc_row = d.doc_row left join named n on n.doc_row = d.doc_row
"""

ORACLE_SQL: dict[str, str] = {
    "op11_filter_audit": _FILTER_AUDIT,
    "op12_collocations": _COLLOCATIONS,
    "op13_decontamination": _DECONTAMINATION,
}
