"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import url_filter

#: Words by ASCII white space; DuckDB's regular expressions know the same ranges.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as text, {WORDS} as w, string_split(coalesce(text, ''), chr(10)) as raw from documents),
f as (select *, list_filter(raw, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as s from d),
g as (select row, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as g from (select row, w, unnest(range(1, len(w) - 1)) as p from d)),
t as (select row, p from g qualify count(*) over (partition by row, g) > 1),
r as (select row, count(distinct q) as n from (select row, unnest([p, p + 1, p + 2]) as q from t) group by row),
b as (select doc_id, text, raw, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(s as bigint) as n_symbols,
      cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words from f left join r using (row))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > 3 * n_words or word_chars < 2 * n_words or word_chars > 15 * n_words or 2 * n_dup_lines > len(raw)
    or 5 * len(regexp_extract_all(text, '\p{{Lu}}{{2,}}')) > 3 * n_words or 2 * len(regexp_extract_all(text, '\S*\p{{L}}\S*')) < n_words
    or 10 * len(regexp_extract_all(text, '(?m)^\s*[-*•]')) > 9 * len(raw)) as kept from b
"""

CHAT = """
with t as (select conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) order by turn, coalesce(role, ''), coalesce(text, '')) as turns from conversations group by conv_id),
a as (select *, len(turns) + 1 - list_position(list_reverse(list_transform(turns, lambda x: x.role)), 'assistant') as at_ from t),
g as (select *, conv_id as donor, case when at_ is not null then turns[at_:] end as tail, cast(floor(conv_id / 1024.0) as bigint) as block from a),
r as (select *, coalesce(lead(donor) over w, first(donor) over w) as donor_id, coalesce(lead(tail) over w, first(tail) over w) as got from g window w as (partition by block, at_ is null order by conv_id)),
p as (select conv_id, case when at_ is not null then donor_id end as donor_id, turns as c, case when at_ is not null then list_concat(turns[1:at_ - 1], got) end as r from r),
n as (select *, case when r is null then len(c) else coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] is distinct from r[i])) - 1, len(c)) end as n_common from p),
s as (select *, case when r is null then [] else c[n_common + 1:] end as cr, case when r is null then [] else r[n_common + 1:] end as rr from n)
select conv_id, donor_id, cast(n_common as bigint) as n_common,
  list_aggregate(list_concat([''], list_transform(c[1:n_common], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10))), 'string_agg', '') as prompt,
  case when r is not null then list_aggregate(list_concat([''], list_transform(cr, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10))), 'string_agg', '') end as chosen,
  case when r is not null then list_aggregate(list_concat([''], list_transform(rr, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10))), 'string_agg', '') end as rejected,
  case when r is not null then array_to_string(list_transform(list_filter(range(1, len(cr) + 1), lambda i: cr[i].role = 'assistant'), lambda i: cast(list_sum(list_concat([0], list_transform(cr[1:i - 1], lambda x: length(x.role) + length(x.text) + 13))) + length(cr[i].role) + 5 as bigint) || '-' || cast(list_sum(list_concat([0], list_transform(cr[1:i], lambda x: length(x.role) + length(x.text) + 13))) - 1 as bigint)), ',') end as chosen_mask,
  case when r is not null then array_to_string(list_transform(list_filter(range(1, len(rr) + 1), lambda i: rr[i].role = 'assistant'), lambda i: cast(list_sum(list_concat([0], list_transform(rr[1:i - 1], lambda x: length(x.role) + length(x.text) + 13))) + length(rr[i].role) + 5 as bigint) || '-' || cast(list_sum(list_concat([0], list_transform(rr[1:i], lambda x: length(x.role) + length(x.text) + 13))) - 1 as bigint)), ',') end as rejected_mask,
  case when r is null then 'no_reply' when len(cr) = 0 and len(rr) = 0 then 'identical' else 'pair' end as status
from s
"""

URLS = rf"""
with u as (select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages),
h as (select page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') as raw from u),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') as path from h),
rules(rh, rp, what) as (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
best as (select page_id, max_by(rh || rp, length(rh || rp)) as rule, max_by(what, length(rh || rp)) as what from p join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
select p.page_id, host, path, rule, coalesce(what, case when regexp_matches(host, '(^|\.)({"|".join(url_filter.FIRST)})-({"|".join(url_filter.SECOND)})\.example\.(com|net|org)$') then 'block' else 'allow' end) as verdict
from p left join best using (page_id)
"""

LINES = r"""
with d as (select row_number() over () as row, doc_id, source, coalesce(text, '') as text from documents),
l as (select distinct row, source, line from (select row, source, unnest(string_split(text, chr(10))) as line from d) where regexp_matches(line, '[^\x20\x09-\x0D]')),
t as (select source, count(*) as total from d group by source),
bad as (select c.source, list(line) as lines from (select source, line, count(*) as pages from l group by source, line) c join t on c.source is not distinct from t.source where pages >= 5 and pages > 0.1 * total group by c.source),
k as (select d.*, string_split(text, chr(10)) as a, list_filter(string_split(text, chr(10)), lambda x: not coalesce(list_contains(bad.lines, x), false)) as b from d left join bad on d.source is not distinct from bad.source)
select doc_id, source, array_to_string(b, chr(10)) as text, cast(len(a) as bigint) as n_lines, cast(len(a) - len(b) as bigint) as n_dropped from k
"""

MIX = rf"""
with d as (select doc_id, source, cast(len({WORDS}) as bigint) as size, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as hash from documents),
s as (select source, cast(sum(size) as hugeint) as n, row_number() over (order by source nulls last) as place from d group by source),
w as (select *, [1, 2, 3][(place - 1) % 3 + 1] as weight from s),
o as (select *, sum(n) over () - 3 * coalesce(sum(n) over b, 0) as rest, sum(weight) over () - coalesce(sum(weight) over b, 0) as wrest from w window b as (order by 3.0 * n / weight, place rows between unbounded preceding and 1 preceding)),
l as (select *, first(case when rest * weight <= 3 * n * wrest then [rest, wrest] end ignore nulls) over (order by 3.0 * n / weight, place rows between unbounded preceding and current row) as level from o),
t as (select source, cast(n as bigint) as source_size, case when level is null then cast(3 * n as double) else cast(level[1] as double) * weight / level[2] end as target from l),
c as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as base from t),
r as (select *, sum(size) over (partition by source, hash) as g, row_number() over (partition by source, hash) as nth, sum(size) over (partition by source order by hash) as upto from d),
x as (select doc_id, size, source_size, target, base, target - base * source_size as need, nth, g, upto from r join c on r.source is not distinct from c.source),
y as (select *, base + case when upto <= need then 1 when upto - g <= need and nth <= ceil((need - (upto - g)) / size - 0.5) then 1 else 0 end as k from x)
select doc_id, size, source_size, target, cast(k * size as bigint) as taken, cast(k as bigint) as copies from y
"""

NEGATIVES = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label as wanted, b.vec_id, b.label, cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where label = wanted qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and label <> wanted and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) <= 10
"""


def sql() -> dict[str, str]:
    return {"op3_quality_rules": QUALITY_RULES, "op5_chat_formatting": CHAT, "op7_url_filters": URLS, "op8_line_dedup": LINES, "op9_mixing": MIX, "op11_hard_negatives": NEGATIVES}
