"""DuckDB SQL for the queries."""

from __future__ import annotations

from .arms import FIELDS, arm_sql

#: From the most severe on: a gap of the candidate, other values, what the candidate alone fills, then what is cosmetic.
_CATS = ("truth_only", "value_diff", "candidate_only", "order_diff", "numeric_tol", "flag_expected")
_NUM = r"'^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
_CLOSE = "(abs({a} - {b}) <= 1e-3 * greatest(abs({a}), abs({b})))"
_SETS = "(len(string_split({a}, '{s}')) > 1 and list_sort(string_split({a}, '{s}')) = list_sort(string_split({b}, '{s}')) and {a} <> {b})"

ARMS = "with " + arm_sql("string_agg({what}, ',' order by {order})")


def _side(name: str, records: str) -> str:
    return f"""
k_{name} as (select *, replace(contig, 'chr', '') as ctg, list_sort(string_split(alt, ',')) as alts from {records}),
n_{name} as (select *, row_number() over (partition by run, ctg, pos, ref, alts order by seq) as rec from k_{name}),
u_{name} as (select *, unnest(string_split(packed, ',')) as entry, generate_subscripts(string_split(packed, ','), 1) - 1 as entry_no from n_{name}),
p_{name} as (select *, string_split(entry, '|') as p from u_{name}),
v_{name} as (select run, ctg as contig, pos, ref, alt, alts, seq, rec, entry_no, coalesce(p[1], '') as allele, coalesce(p[2], '') as feature, list_transform(range(3, 9), lambda i: coalesce(p[i], '')) as vals, len(p) < 2 as malformed from p_{name}),
f_{name} as (select *, row_number() over (partition by run, contig, pos, ref, alts, seq, allele, feature order by entry_no) as first from v_{name} where not malformed),
ann_{name} as (select * from f_{name} where first = 1 and rec = 1)"""


STUDY = f"""{ARMS},{_side('c', 'rec_c')},{_side('t', 'rec_t')},
j as (select coalesce(c.run, t.run) as run, coalesce(c.contig, t.contig) as contig, coalesce(c.pos, t.pos) as pos, coalesce(c.ref, t.ref) as ref, c.alt, coalesce(c.allele, t.allele) as allele, coalesce(c.feature, t.feature) as feature, c.vals as l, t.vals as r,
  case when c.run is null then 'truth' when t.run is null then 'candidate' else 'both' end as state
  from ann_c c full join ann_t t on c.run = t.run and c.contig = t.contig and c.pos = t.pos and c.ref = t.ref and c.alts = t.alts and c.allele = t.allele and c.feature = t.feature),
x0 as (select j.*, f.i, f.field, l[f.i] as candidate_val, r[f.i] as truth_val, case when l[f.i] in ('', '-', '.') then '' else l[f.i] end as a, case when r[f.i] in ('', '-', '.') then '' else r[f.i] end as b
  from j, (values {', '.join(f"({i + 1}, '{f}')" for i, f in enumerate(FIELDS))}) f(i, field) where state = 'both'),
x as (select run, contig, pos, ref, alt, allele, feature, field, candidate_val, truth_val, case when field = 'Tax' and run <> 'm_am' and a <> '' and b = '' then 'flag_expected' when a = '' then 'truth_only' when b = '' then 'candidate_only'
  when regexp_matches(a, {_NUM}) and regexp_matches(b, {_NUM}) then case when {_CLOSE.format(a='try_cast(a as double)', b='try_cast(b as double)')} then 'numeric_tol' else 'value_diff' end
  when {_SETS.format(a='a', b='b', s='&')} or {_SETS.format(a='a', b='b', s=',')} then 'order_diff' else 'value_diff' end as category from x0 where a <> b),
cov as (select run, count(*) filter (state = 'both') as aligned, count(*) filter (state = 'candidate') as only_candidate, count(*) filter (state = 'truth') as only_truth from j group by run),
g as (select run, field, {', '.join(f"count(*) filter (category = '{c}') as {c}" for c in _CATS)}, count(*) as bad from x group by run, field),
fld as (select cov.run, f.field, aligned as total, aligned - coalesce(bad, 0) as match, {', '.join(f'coalesce({c}, 0) as {c}' for c in _CATS)} from cov cross join (select unnest({FIELDS!r}) as field) f left join g on g.run = cov.run and g.field = f.field)"""


def _bad(side: str, name: str) -> str:
    return f"""m_{side} as (select run, contig, count(*) as malformed_{name} from (select run, contig from v_{side} where malformed union all select run, contig from f_{side} where first > 1) q group by run, contig),
d_{side} as (select run, ctg as contig, count(*) as duplicate_{name} from n_{side} where rec > 1 group by run, ctg)"""


_COUNTS = ("aligned", "only_candidate", "only_truth", "malformed_candidate", "malformed_truth", "duplicate_candidate", "duplicate_truth")
_BY_CATEGORY = "array_to_string(list_sort(list_filter([" + ", ".join(f"case when {c} > 0 then '{c}=' || {c} end" for c in _CATS) + "], lambda x: x is not null)), ',')"
SHARDS = f"""{STUDY},{_bad('c', 'candidate')},{_bad('t', 'truth')},
covc as (select run, contig, count(*) filter (state = 'both') as aligned, count(*) filter (state = 'candidate') as only_candidate, count(*) filter (state = 'truth') as only_truth from j group by run, contig),
sh as (select covc.*, coalesce(malformed_candidate, 0) as malformed_candidate, coalesce(malformed_truth, 0) as malformed_truth, coalesce(duplicate_candidate, 0) as duplicate_candidate, coalesce(duplicate_truth, 0) as duplicate_truth
  from covc left join m_c using (run, contig) left join m_t using (run, contig) left join d_c using (run, contig) left join d_t using (run, contig)),
mg as (select run, {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in _COUNTS)}, string_agg(contig, ',' order by contig) as contigs, string_agg(run || '/' || contig, ',' order by run || '/' || contig) as mismatches, case when bool_and(aligned + only_truth > 0) then 'ok' else 'no_gt' end as status, case when run = 'clean' then 'base' else 'merged' end as cache from sh group by run),
wide as (select run, max(c) as c, max(t) as t from (select run, len(p) as c, 0 as t from p_c union all select run, 0, len(p) from p_t) q group by run),
one as (select run, least(c, t) - 2 as shared_fields, case when c > greatest(t, 8) then ['Extra'] else [] end as c_only, case when t > greatest(c, 8) then ['Score'] else [] end as t_only from wide),
mr as (select mg.*, shared_fields, c_only, t_only, round_even(aligned / nullif(aligned + only_candidate + only_truth, 0), 4) as join_rate from mg join one using (run)),
cv as (select *, only_candidate + only_truth as not_compared, list_filter([case when join_rate < 0.99 then 'join_rate' end, case when only_truth > 0 then 'only_truth' end, case when only_candidate > 0 then 'only_candidate' end, case when malformed_candidate > 0 then 'malformed_candidate' end,
  case when duplicate_candidate > 0 then 'duplicate_candidate' end, case when malformed_truth > 0 then 'malformed_truth' end, case when duplicate_truth > 0 then 'duplicate_truth' end, case when len(t_only) > 0 then 'truth_only_fields' end, case when len(c_only) > 0 then 'candidate_only_fields' end], lambda w: w is not null) as w from mr)"""

_PCT = "round_even(100.0 * {a} / nullif({b}, 0), 3)"
_DRIFT = f"""dr as (select run, field, {' + '.join(_CATS)} as mismatches, {' + '.join(_CATS)} - flag_expected as real, {_PCT.format(a='cast(match as double)', b='total')} as pct,
  list_max([{', '.join(f'{{n: {c}, s: -{i}}}' for i, c in enumerate(_CATS))}]).s as s, {_BY_CATEGORY} as by_category, {' + '.join(_CATS)} = flag_expected as all_expected from fld where {' + '.join(_CATS)} > 0)"""
_DAYS = "days as (select o_orderstatus as contig, cast(year(o_orderdate) * 400 + dayofyear(o_orderdate) as bigint) as pos from orders)"
_SAMPLES = """few as (select *, row_number() over (partition by run, contig, field, category order by pos, ref, alt, allele, feature) as n from x),
smp as (select *, contig || ':' || pos || ' ' || ref || '>' || alt || ' ' || allele || '|' || feature as locus, row_number() over (partition by run, field order by cast(contig as int), pos, ref, alt, allele, feature, category) as place from few where n <= 5)"""
_KIND = "case when feature = '' then 'NONE' when starts_with(feature, 'ENS') then 'ENSEMBL' when feature[:3] in ('XM_', 'NM_', 'XR_', 'NR_', 'NP_') then 'REFSEQ' else 'OTHER' end"
_RANGES = """lim as (select contig, n, at_ as b, lag(at_) over (partition by contig order by i) as a from ct),
rg0 as (select contig, b - a as n, (select min(pos) from pc where pc.contig = lim.contig and upto > a) as lo, (select max(pos) from pc where pc.contig = lim.contig and upto <= b) as hi, (select min(pos) from pc where pc.contig = lim.contig and upto > b) as nxt, b from lim where b > a),
rg1 as (select *, case when nxt is null then hi else (hi + nxt) // 2 end as e from rg0),
rg as (select contig, cast(row_number() over (partition by contig order by b) - 1 as int) as chunk, cast(coalesce(lag(e) over (partition by contig order by b) + 1, lo) as bigint) as start, cast(e as bigint) as "end", cast(n as bigint) as n from rg1)"""
_COUNTED = f"""{_DAYS},
pc as (select contig, pos, count(*) as n, sum(count(*)) over (partition by contig order by pos) as upto from days group by contig, pos),
tot as (select contig, cast(sum(n) as bigint) as n from pc group by contig)"""
_CUTS = f"""{_COUNTED},
ct as (select contig, n, 0 as i, cast(0 as bigint) as at_ from tot union all
  select ct.contig, ct.n, i + 1, cast((select min(upto) from pc where pc.contig = ct.contig and pc.upto >= least(ct.n, at_ + ct.n // 9 + case when i < ct.n % 9 then 1 else 0 end)) as bigint) from ct where i < 9),
{_RANGES}"""
_FREE_CUTS = f"""{_COUNTED},
ct as (select contig, n, i, cast(case when i = 0 then 0 else (select min(upto) from pc where pc.contig = tot.contig and pc.upto >= i * (tot.n // 9) + least(i, tot.n % 9)) end as bigint) as at_ from tot cross join (select unnest(range(10)) as i) k),
{_RANGES}"""
_OVERVIEW = """o as (select run, round_even(100.0 * cast(sum(match) as double) / sum(total), 3) as overall_pct, round_even(100.0 * cast(sum(match + flag_expected) as double) / sum(total), 3) as true_pct from fld group by run)"""
_RISK = "case when len(w) > 0 then case when not_compared > 0 then 'not_compared ' || not_compared || '/' || (aligned + not_compared) else w[1] end || case when len(w) > 1 then ' +' || (len(w) - 1) || ' more' else '' end end"


_SETTINGS = """with e as (select distinct event_type as flag, cast(user_id % 30 as varchar) as run from events where (event_type <> 'purchase' or user_id % 30 % 3 = 0) and (event_type <> 'signup' or user_id % 30 % 4 = 0)),
k as (select * from (values ('click', 'semantic'), ('view', 'ignored'), ('purchase', 'flavour'), ('signup', 'flavour')) t(flag, kind))"""


def sql() -> dict[str, str]:
    arms = lambda s: f"{ARMS} {s}"
    study = lambda s: f"{STUDY} {s}"
    shards = lambda s: f"{SHARDS} {s}"
    matrix = lambda v: "select run, " + ", ".join(f"max(case when field = '{f}' then {v} end) as {f.lower()}" for f in FIELDS) + " from fld group by run"
    every_field = "run, field, total, match, " + ", ".join(_CATS)
    plan = """with li as (select l_orderkey as key, count(*) as n, cast(sum(l_linenumber * 5) as double) as actual from lineitem group by 1),
      p as (select o_orderkey as key, cast(o_orderkey % 40 + 10 as double) as est, li.n, case when li.n > 2 then actual end as actual from orders left join li on li.key = o_orderkey),
      s as (select key, case when n is null then 'missing' when actual is null then 'annotated' else 'done' end as state, coalesce(actual > est * 1.25, false) as overran from p)"""
    return {
        "scan_packed": arms("select run, replace(contig, 'chr', '') as contig, pos, ref, alt, packed, seq from rec_c"),
        "scan_text": arms("select run, replace(contig, 'chr', '') as contig, pos, ref, alt, packed from rec_c"),
        "build_arms": arms("select run, count(*) filter (s = 'c') as candidate, count(*) filter (s = 't') as truth from (select run, 'c' as s from rec_c union all select run, 't' from rec_t) q group by run"),
        "scan_blocks": arms("select run, replace(contig, 'chr', '') as contig, pos, ref, alt, packed from rec_c"),
        "scan_positions": arms("select replace(contig, 'chr', '') as contig, pos from rec_c"),
        "scan_keys": arms("select distinct replace(contig, 'chr', '') as contig, pos, ref, alt from rec_c"),
        "annotated_records": arms("select replace(contig, 'chr', '') as contig, count(*) as n from rec_c group by 1"),
        "dimension_table": "select cast(s_suppkey as bigint) as s_suppkey, s_name, cast(s_nationkey as int) as s_nationkey from supplier",
        "mismatch_quotes": study("select contig, pos, ref, alt, allele, feature, field, '\"' || candidate_val || '\" \\' || field || chr(9) as candidate_val, truth_val || chr(10) || '\"\"' as truth_val from x"),
        "bucketed_runs": study("select * from cov"),
        "incremental_fields": study(f"select {every_field} from fld"),
        "packed_lookup": study("select run, contig, pos, seq, array_to_string(vals, '|') as vals from (select *, row_number() over (partition by run, contig, pos, ref, alts, seq order by entry_no) as nth from v_c where allele = 'N' and feature = '' and pos % 3 = 0 and not malformed) q where nth = 1"),
        "observed_outputs": arms(""", p as (select distinct run, replace(contig, 'chr', '') as c from rec_c),
          f as (select 'run=' || run || '/contig=' || c as key, cast(c as double) as est, cast(c as int) % 5 <> 0 and c <> '1' as there, case when cast(c as int) % 3 <> 0 then case when cast(c as int) % 4 = 0 then 2.0 * cast(c as double) else cast(c as double) end end as actual from p)
          select key, case when not there then 'missing' when actual is null then 'annotated' else 'done' end as state, there and coalesce(actual > est * 1.25, false) as overran from f"""),
        "planned_concat": """with s as (select cast(o_orderkey % 22 + 1 as varchar) as contig, o_custkey % 12 as chunk, count(*) as n from orders group by 1, 2),
          p as (select contig, chunk from s where chunk <> 3 union all select '9', n_nationkey + 100 from nation where n_nationkey < 2)
          select coalesce(s.contig, p.contig) as contig, coalesce(s.chunk, p.chunk) as chunk, coalesce(n, 0) as n, case when p.contig is null then 'unplanned' when s.contig is null then 'missing' else 'ok' end as state, case when p.contig is null then 0 else coalesce(n, 0) end as rows
          from s full join p on s.contig = p.contig and s.chunk = p.chunk""",
        "range_input": """with o as (select o_orderstatus as contig, cast(o_orderkey as bigint) as pos, cast(case when o_orderkey % 100 = 0 then o_orderkey + 150 else o_orderkey end as bigint) * 10000000000 + o_orderkey as seq from orders),
          p as (select *, lag(pos) over (partition by contig order by seq) as previous from o)
          select contig, 'unsorted' as violation, seq, pos, previous from p where pos < previous
          union all select distinct n_name[1:1], 'empty', cast(null as bigint), cast(null as bigint), cast(null as bigint) from nation where n_name[1:1] not in (select o_orderstatus from orders)""",
        "settings_cells": "select cast(user_id % 30 as varchar) as run, event_type as flag, cast(count(*) as varchar) as value from events group by 1, 2",
        "contig_ranks": arms("select run, replace(contig, 'chr', '') as contig, cast(row_number() over (partition by run order by contig) - 1 as int) as rank from (select distinct run, contig from rec_c) q"),
        "mismatch_text": study("select contig, pos, ref, alt, allele, feature, field, candidate_val, truth_val, category from x"),
        "summary_text": shards("select mr.run, aligned, only_candidate, only_truth, malformed_candidate, malformed_truth, duplicate_candidate, duplicate_truth, contigs, join_rate, f.total, f.match from mr join (select run, cast(sum(total) as bigint) as total, cast(sum(match) as bigint) as match from fld group by run) f on f.run = mr.run"),
        "unpack_annotations": study("select run, contig, pos, seq, cast(entry_no as bigint) as entry_no, allele, feature, array_to_string(vals, '|') as vals, malformed from v_t"),
        "malformed_counts": study("select run, count(*) as malformed from (select run from v_t where malformed union all select run from f_t where first > 1) q group by run"),
        "duplicate_records": study("select run, count(*) as surplus from n_t where rec > 1 group by run"),
        "alt_order_join": study("select c.run, count(*) as records, count(*) filter (c.alt <> t.alt) as reordered from n_c c join n_t t on c.run = t.run and c.ctg = t.ctg and c.pos = t.pos and c.ref = t.ref and c.alts = t.alts where c.rec = 1 and t.rec = 1 group by c.run"),
        "split_multiallelic": arms("select run, contig, pos, ref, unnest(string_split(alt, ',')) as alt, seq from rec_c"),
        "split_count_gate": arms("select count(*) as records, cast(sum(len(string_split(alt, ',')) - 1) as bigint) as extra, cast(sum(len(string_split(alt, ','))) as bigint) as expected from rec_c"),
        "annotation_full_outer": study("select run, contig, pos, ref, allele, feature, state from j"),
        "coverage_counts": study("select * from cov"),
        "join_rate": study("select run, round_even(aligned / (aligned + only_candidate + only_truth), 4) as join_rate from cov"),
        "cell_mismatches": study("select run, contig, pos, ref, allele, feature, alt, field, candidate_val, truth_val, category from x"),
        "drift_classify": study("select run, field, category, count(*) as n from x group by run, field, category"),
        "sentinel_match": study("select run, count(*) filter (a = b) as same_by_sentinel from x0 where i = 6 and candidate_val <> truth_val group by run"),
        "numeric_tolerance": f"with r as (select l_linenumber, cast(cast(l_quantity as decimal(12,2)) as double) as a, cast(cast(l_quantity + (l_linenumber - 4) * 0.01 as decimal(12,2)) as double) as b from lineitem) select l_linenumber, count(*) filter {_CLOSE.format(a='a', b='b')}" + f" as close, count(*) filter (not {_CLOSE.format(a='a', b='b')}) as apart from r group by l_linenumber",
        "order_only_diff": f"with r as (select concat(l_returnflag, '&', l_linestatus) as a, concat(l_linestatus, '&', case when l_partkey % 3 = 0 then 'X' else l_returnflag end) as b from lineitem) select a, b, count(*) filter ({_SETS.format(a='a', b='b', s='&')}) as order_only from r group by a, b",
        "per_field_concordance": study(f"select {every_field}, {_PCT.format(a='cast(match as double)', b='total')} as pct from fld"),
        "overall_concordance": study("select run, cast(sum(total) as bigint) as total, cast(sum(match) as bigint) as match, round_even(100.0 * cast(sum(match) as double) / sum(total), 3) as overall_pct from fld group by run"),
        "mismatch_samples": f"{STUDY}, {_SAMPLES} select run, contig, pos, ref, alt, allele, feature, field, candidate_val, truth_val, category, locus, cast(place as int) as place from smp where place <= 15",
        "merge_shards": shards("""select run, aligned, only_candidate, only_truth, malformed_candidate, malformed_truth, duplicate_candidate, duplicate_truth, cache, cast(shared_fields as int) as shared_fields, array_to_string(c_only, ',') as candidate_only_fields,
          array_to_string(t_only, ',') as truth_only_fields, status, contigs, mismatches, join_rate from mr"""),
        "merge_fields": study(f"select {every_field}, {_PCT.format(a='cast(match as double)', b='total')} as pct from fld"),
        "shard_set_violations": f"""{SHARDS},
          s1 as (select run, contig, case when run = 'm' and contig = '3' then 'failed' else 'ok' end as status, case when run = 'm' and contig = '4' then 'other' when run = 'clean' then 'base' else 'merged' end as cache, case when run = 'm_am' and contig = '8' then 5 else 6 end as shared_fields from sh where not (run = 'clean' and contig = '5')),
          s2 as (select * from s1 union all select * from s1 where run = 'm_am' and contig = '7'),
          want as (select run, contig from sh where not (run = 'm' and contig = '9')),
          fs as (select run, contig, list_sort(list(field)) as l from (select sh.run, sh.contig, f.field from sh cross join (select unnest({FIELDS!r}) as field) f) q where not (run = 'clean' and contig = '2' and field = 'Note') group by run, contig)
          select run, contig, 'duplicate' as violation from s2 group by run, contig having count(*) > 1 union all select run, contig, 'failed' from s2 where status <> 'ok'
          union all select run, contig, 'missing' from (select * from want except select run, contig from s2) a union all select run, contig, 'unexpected' from (select run, contig from s2 except select * from want) b
          union all select run, null, 'cache' from s2 group by run having count(distinct cache) > 1 union all select run, null, 'shared_fields' from s2 group by run having count(distinct shared_fields) > 1
          union all select run, null, 'field_set' from fs group by run having count(distinct l) > 1""",
        "required_runs": arms("select run, 'missing_run' as violation from (select unnest(['clean', 'm_am']) as run) d where run not in (select run from rec_c where run <> 'clean') union all select distinct run, 'unknown_run' from rec_c where run <> 'clean' and run not in ('clean', 'm_am')"),
        "run_status": f"""{SHARDS}, st as (select run, case when run = 'm' or (run = 'm_am' and contig = '3') then 'no_gt' else 'ok' end as status from sh)
          select run, count(*) as shards, count(*) filter (status <> 'ok') as failed, case when count(*) filter (status <> 'ok') = 0 then 'ok' when count(*) filter (status = 'ok') = 0 then 'stub' else 'mixed' end as run_status from st group by run""",
        "true_concordance": study("select run, cast(sum(total) as bigint) as total, cast(sum(match + flag_expected) as bigint) as agreed, round_even(100.0 * cast(sum(match + flag_expected) as double) / sum(total), 3) as true_pct from fld where total > 0 group by run"),
        "coverage_verdict": shards("select run, join_rate, not_compared, array_to_string(w, ',') as warnings, cast(len(w) as bigint) as n_warnings, len(w) = 0 as trustworthy from cv"),
        "headline_risk": shards(f"select run, case when run = 'm_am' then 'status no_gt' else {_RISK} end as risk from cv"),
        "category_rollup": study(" union all ".join(f"select {i + 1} as place, '{c}' as category, cast(coalesce(sum({c}), 0) as bigint) as cells from fld" for i, c in enumerate(_CATS))),
        "drift_rows": f"{STUDY}, {_DRIFT} select run, field, mismatches, real, pct, {list(_CATS)!r}[1 - s] as dominant, by_category, all_expected from dr",
        "worst_fields": f"""{STUDY}, {_DRIFT}, {_SAMPLES}, ex as (select run, field, string_agg(locus || ' ' || category, ';' order by place) as e from smp where place <= 3 group by run, field)
          select q.run, q.field, real, cast(place as int) as place, dominant, case when place <= 2 then e end as examples from (select *, {list(_CATS)!r}[1 - s] as dominant, row_number() over (partition by run order by real desc, mismatches desc, field) as place from dr) q join ex on ex.run = q.run and ex.field = q.field where place <= 4""",
        "triage_counts": study(f"select field, category, {_KIND} as kind, count(*) as cells from x group by 1, 2, 3"),
        "triage_rollup": f"""{STUDY}, c1 as (select field, string_agg(category || '=' || n, ',' order by category) as by_category from (select field, category, count(*) as n from x group by 1, 2) q group by field),
          k1 as (select field, string_agg(kind || '=' || n, ',' order by kind) as by_kind, cast(sum(n) as bigint) as total from (select field, {_KIND} as kind, count(*) as n from x group by 1, 2) q group by field),
          s1 as (select field, string_agg(concat_ws(':', run, contig, pos, allele, feature, category), ';' order by n) as samples from (select *, row_number() over (partition by field order by cast(contig as int), run, pos, ref, alt, allele, feature, category, candidate_val, truth_val) as n from x) q where n <= 5 group by field)
          select c1.field, total, by_category, by_kind, samples from c1 join k1 using (field) join s1 using (field)""",
        "prefix_kind_rollup": "select case p_partkey % 5 when 0 then 'NONE' when 1 then 'ENSEMBL' when 2 then 'REFSEQ' when 3 then 'REFSEQ' else 'OTHER' end as kind, count(*) as n from part group by 1",
        "slice_distinct_ids": study("select distinct feature from x where field = 'Price' and category = 'numeric_tol' order by feature limit 20"),
        "fields_moved": study(f"select run, field, total - match as moved, total, {_PCT.format(a='cast(match as double)', b='total')} as identical_pct, {_BY_CATEGORY} as by_category from fld where total > match"),
        "moved_totals": study("select field, cast(sum(total - match) as bigint) as cells from fld group by field having sum(total - match) > 0"),
        "structure_violations": shards("select run, 'one_sided' as violation from mr where only_candidate > 0 or only_truth > 0 or join_rate is distinct from 1.0"),
        "moved_summary": f"""{SHARDS}, fit as (select * from mr where only_candidate = 0 and only_truth = 0 and join_rate = 1.0)
          select (select count(*) from fit) as runs, (select cast(coalesce(sum(aligned * 6), 0) as bigint) from fit) as cells, (select cast(coalesce(sum(total - match), 0) as bigint) from fld where run in (select run from fit)) as moved,
          round_even(100.0 * (select cast(sum(total - match) as double) from fld where run in (select run from fit)) / (select sum(aligned * 6) from fit), 6) as moved_pct""",
        "moved_matrix": study(matrix("total - match")),
        "concordance_matrix": study(matrix(_PCT.format(a="cast(match as double)", b="total"))),
        "run_overview": f"""{SHARDS}, {_OVERVIEW} select list_position(['clean', 'm', 'm_am'], cv.run) as place, cv.run, cache, overall_pct, true_pct, join_rate, aligned, status, len(w) = 0 as trustworthy, {_RISK} as risk from o join cv on o.run = cv.run""",
        "contig_counts": arms("select replace(contig, 'chr', '') as contig, count(*) as n from rec_c group by 1"),
        "contig_filter": arms("select run, '7' as contig, pos, ref, alt from rec_c where contig = 'chr7'"),
        "region_slice": arms("select run, contig, pos from rec_c where contig = 'chr7' and pos between 1000 and 20000"),
        "natural_order": arms("select contig, row_number() over (order by case when regexp_matches(contig, '^[0-9]+$') then 0 else 1 end, try_cast(contig as bigint), contig) as place from (select distinct replace(contig, 'chr', '') as contig from rec_c union all select 'X' union all select 'MT') q"),
        "field_asymmetry": "with p as (select *, p_brand || '_' || (p_partkey % 40) as field from part), a as (select distinct field as c from p where p_size < 30), b as (select distinct field as c from p where p_size > 20) select case when a.c is null then 'truth_only' when b.c is null then 'candidate_only' else 'shared' end as part, coalesce(a.c, b.c) as field from a full join b on a.c = b.c",
        "keyset_compare": arms(", a as (select distinct contig, pos, ref, alt from rec_c), b as (select distinct contig, pos, ref, alt from rec_t), f as (select a.pos as x, b.pos as y from a full join b on a.contig = b.contig and a.pos = b.pos and a.ref = b.ref and a.alt = b.alt) select count(x) as n_left, count(y) as n_right, count(*) filter (x is not null and y is not null) as n_both, count(*) filter (y is null) as only_left, count(*) filter (x is null) as only_right, count(*) = count(x) and count(*) = count(y) as identical from f"),
        "keyset_only_left": arms("select contig, pos, ref, alt from rec_c except select contig, pos, ref, alt from rec_t"),
        "keyset_examples": arms("select * from (select contig, pos, ref, alt from rec_t except select contig, pos, ref, alt from rec_c) q order by contig, pos, ref, alt limit 10"),
        "unranked_contigs": arms("select distinct replace(contig, 'chr', '') as contig from rec_c except select cast(n_nationkey as varchar) from nation where cast(n_nationkey as varchar) < '3'"),
        "order_violations": """with e as (select event_type as source, strftime(ts, '%Y-%m-%d') as contig, epoch_us(ts) as pos, (case when event_id % 50 = 0 then event_id + 75 else event_id end) * 1000000 + event_id as seq from events),
          r as (select contig, row_number() over (order by contig) as rank from (select distinct contig from e where contig not like '%-07') d),
          w as (select source, e.contig, pos, seq, rank, lag(e.contig) over o as pc, lag(pos) over o as pp, lag(rank) over o as pr from e left join r on r.contig = e.contig window o as (partition by source order by seq)),
          k as (select *, case when rank is null then 'unranked' when rank < pr then 'contig' when contig = pc and pos < pp then 'position' end as kind from w)
          select source, kind, contig, pos, pc as previous_contig, pp as previous_pos, seq from k where kind is not null""",
        "positional_residual": """with l as (select o_orderstatus as contig, row_number() over (partition by o_orderstatus order by o_orderkey) as rn, o_orderkey || case when o_orderkey % 7 = 0 then ';v=1' else '' end || case when o_orderkey % 50 = 0 then ';a' else '' end as a,
            o_orderkey || case when o_orderkey % 50 = 0 then ';b' else '' end as b from orders),
          d as (select contig, rn, a <> b as d, regexp_replace(a, ';v=[0-9]+', '', 'g') <> regexp_replace(b, ';v=[0-9]+', '', 'g') as r from l),
          f as (select contig, string_agg(rn, ',' order by rn) as first from (select contig, rn, row_number() over (partition by contig order by rn) as n from d where r) q where n <= 3 group by contig)
          select d.contig, count(*) as lines, count(*) filter (d) as raw, count(*) filter (r) as residual, f.first from d left join f on f.contig = d.contig group by d.contig, f.first""",
        "id_membership": "select distinct p_partkey * 3 as id, p_partkey * 3 in (select l_partkey from lineitem) as present from part",
        "plan_vs_observed": f"{plan} select * from s",
        "plan_vs_observed_summary": f"{plan} select state, count(*) as n, count(*) filter (overran) as overran from s group by state",
        "manifest_reconcile": """with a as (select c_name as name, case when c_custkey % 17 = 0 then 'none' else md5(c_name) end as a from customer where c_custkey % 11 <> 0),
          b as (select c_name as name, case when c_custkey % 19 = 0 then 'none' else md5(c_name || case when c_custkey % 13 = 0 then 'x' else '' end) end as b from customer where c_custkey % 7 <> 0),
          s as (select coalesce(a.name, b.name) as name, case when a is null then 'extra' when not regexp_matches(a, '^[0-9a-f]{32}$') then 'malformed' when b is null then 'missing' when a <> b then 'differs' end as status from a full join b on a.name = b.name)
          select name, status from s where status is not null""",
        "pairwise_runs": "select 'r1' as a, 'r2' as b, count(*) filter (o_orderkey % 10 = 0 and o_orderkey <> 0) as differing from orders union all select 'r1', 'r3', count(*) filter (o_orderkey % 15 = 0 and o_orderkey <> 0) from orders union all select 'r2', 'r3', count(*) filter ((o_orderkey % 10 = 0) <> (o_orderkey % 15 = 0)) from orders",
        "config_audit": f"{_SETTINGS} select e.run, e.flag, coalesce(kind, 'unknown') as verdict from e left join k on k.flag = e.flag",
        "config_flavours": f"""{_SETTINGS}, d as (select distinct cast(user_id % 30 as varchar) as run, case when user_id % 30 % 3 = 0 then 'purchase' when user_id % 30 % 5 = 0 then 'signup' else 'plain' end as declared from events),
          c as (select run, list_sort(list(e.flag)) as f from e join k on k.flag = e.flag where kind = 'flavour' group by run),
          r as (select d.run, declared, case when coalesce(len(f), 0) < 2 then coalesce(f[1], 'plain') end as resolved from d left join c on c.run = d.run) select run, declared, resolved, case when resolved is null then 'both' when resolved = declared then 'ok' else 'differs' end as verdict from r""",
        "integrity_counts": arms("select run, contig, count(*) filter (s = 'c') as n_left, count(*) filter (s = 't') as n_right from (select run, contig, 'c' as s from rec_c union all select run, contig, 't' from rec_t) q group by run, contig"),
        "pending_shards": arms("select run, contig from rec_c except select run, contig from rec_c where pos % 5 = 0 and run <> 'm'"),
        "union_integrity": arms(", n as (select 'candidate' as part, (select count(*) from rec_c) as n, (select count(*) from rec_c) as expected union all select 'truth', (select count(*) from rec_t), (select count(*) + 1 from rec_t)) select part, n, expected, n = expected as ok from n"),
        "attribute_agreement": """with h as (select l_suppkey % 4 as file, 'k' || (l_partkey % 9) as key, case when l_partkey % 9 < 3 then l_returnflag else 'v' end as value from lineitem),
          g as (select * from h where not (key = 'k5' and file = 2)),
          v as (select key, string_agg(value || ':' || f, ';' order by value) as by_value from (select key, value, string_agg(file, ',' order by file) as f from (select distinct key, value, file from g) z group by key, value) y group by key)
          select g.key, count(distinct file) as files, count(distinct value) as vals, case when count(distinct value) > 1 then 'differs' when count(distinct file) < 4 then 'partial' else 'same' end as verdict, by_value from g join v on v.key = g.key group by g.key, by_value""",
        "balanced_ranges": f"with recursive {_CUTS} select * from rg",
        "independent_ranges": f"with {_FREE_CUTS} select * from rg",
        "range_gaps": f"""with recursive {_CUTS}, bad as (select contig, chunk, start + case when chunk % 4 = 0 then 1 else 0 end as start, "end", n + case when contig = 'P' and chunk = 2 then 1 else 0 end as n from rg),
          lg as (select *, lag("end") over (partition by contig order by chunk) as before from bad), sums as (select contig, sum(n) as n from bad group by contig)
          select contig, chunk, 'gap' as violation from lg where start <> before + 1 union all select contig, chunk, 'reversed' from lg where start > "end" union all select tot.contig, null, 'total' from tot join sums on sums.contig = tot.contig where tot.n <> sums.n""",
        "assign_regions": f"with recursive {_CUTS} select contig, chunk, n from rg",
        "expand_ranges": "with r as (select n_nationkey as id, unnest(list_concat(list_transform(range(n_nationkey + 1, n_nationkey + 5), lambda x: cast(x as varchar)), ['X', cast(n_nationkey as varchar)])) as item from nation) select distinct id, item from r",
        "compress_ranges": "with i as (select distinct l_suppkey % 10 as id, case when l_linenumber = 7 then 'X' else cast(l_partkey % 100 as varchar) end as item from lineitem), n as (select id, try_cast(item as bigint) as n from i where item <> 'X'), g as (select id, n, n - row_number() over (partition by id order by n) as island from n), r as (select id, min(n) as a, case when min(n) = max(n) then cast(min(n) as varchar) else min(n) || '-' || max(n) end as s from g group by id, island), u as (select id, 0 as k, a, s from r union all select id, 1, 0, item from i where item = 'X') select id, string_agg(s, ',' order by k, a) as spec from u group by id",
    }
