"""Two arms of packed records made of lineitem and orders, so that every operator runs on the given tables.

The rules by part key put every kind of disagreement into the truth arm; runs are suppliers modulo three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.sources.records import field_lists, header_catalogue, read_lines
from concord.sources.store import Store, widen

FIELDS = ["Quantity", "Price", "Discount", "Tax", "Tags", "Note"]
N_FIELDS = 8
RUNS = ["clean", "m", "m_am"]
#: The flag that Tax needs, and the flags of each run.
NEEDS = {"Tax": "tax"}
FLAGS = {"clean": [], "m": [], "m_am": ["tax"]}
#: The cache of each run. A ninth packed field, where entries have one, is named so by the side's header.
CACHES = {"clean": "base", "m": "merged", "m_am": "merged"}
KEYS = ["Allele", "Feature"]
NINTH = {"candidate": "Extra", "truth": "Score"}

_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate"
_RUN = "case l_suppkey % 3 when 0 then 'clean' when 1 then 'm' else 'm_am' end as run"
_CONTIG = "concat('chr', cast(l_orderkey % 22 + 1 as string)) as contig"


def _text(x: str) -> str:
    return f"cast(cast({x} as decimal(12,2)) as string)"


_FEATURE = "case when l_partkey % 97 = 0 then '' else concat(case l_partkey % 4 when 0 then 'ENST' when 1 then 'NM_' when 2 then 'P' else 'XR_' end, cast(l_partkey as string)) end as feature"
_CELLS = f"""{_text('l_quantity')} as q, {_text('l_quantity + 1')} as q1, {_text('l_extendedprice')} as price, {_text('l_extendedprice + 0.01')} as price1,
  {_text('l_discount')} as disc, {_text('l_tax')} as tax, concat(l_returnflag, '&', l_linestatus) as tags, concat(l_linestatus, '&', l_returnflag) as gats"""
#: The packed entry of each arm, and which entries the arm has.
_ENTRY_C = "concat(allele, '|', feature, '|', q, '|', price, '|', case when k % 79 = 0 then '' else disc end, '|', tax, '|', tags, '|', case when run = 'm' then '|e' else '' end)"
_ENTRY_T = "case when run <> 'clean' and k % 61 = 0 then allele else concat(allele, '|', feature, '|', case when k % 71 = 0 then q1 else q end, '|', case when k % 89 = 0 then price1 else price end, '|', case when k % 83 = 0 then '' else disc end, '||', case when k % 73 = 0 then gats else tags end, '|', case when k % 67 = 0 then '-' else '' end, case when run = 'm_am' then '|s' else '' end) end"
_HAS_C = "run = 'clean' or k % 101 = 0 or k % 103 <> 0"
_HAS_T = "run = 'clean' or k % 101 <> 0"


def entry_sql() -> str:
    """Common table expression e1: the entries of both arms, a row each."""
    return f"""
e0 as (select {_RUN}, l_orderkey as pos, {_CONTIG},
  o_orderstatus as ref, l_returnflag as allele, {_FEATURE}, l_partkey as k, {_CELLS},
  row_number() over (partition by l_suppkey % 3, l_orderkey order by {_ORDER}) as n from lineitem join orders on l_orderkey = o_orderkey),
e1 as (select * from (select *, row_number() over (partition by run, pos, allele, feature order by n) as rep from e0) x where run <> 'clean' or rep = 1)"""


def record_sql(gather: str) -> str:
    """Common table expressions rec_c and rec_t over e1."""
    join = lambda what, order: gather.format(what=what, order=order)
    return f"""
a0 as (select distinct run, pos, allele from e1),
a1 as (select run, pos, {join('allele', 'allele')} as alt, {join('allele', 'allele desc')} as tla from a0 group by run, pos),
ec as (select run, contig, pos, ref, {join(_ENTRY_C, 'n')} as packed from e1
  where {_HAS_C} group by run, contig, pos, ref),
et as (select run, contig, pos, ref, {join(_ENTRY_T, 'n')} as packed from e1
  where {_HAS_T} group by run, contig, pos, ref),
rec_c0 as (select ec.run, contig, ec.pos, ref, alt, packed, 2 * ec.pos as seq from ec join a1 on ec.run = a1.run and ec.pos = a1.pos),
rec_c as (select * from rec_c0 union all select run, contig, pos, ref, alt, packed, seq + 1 as seq from rec_c0 where run <> 'clean' and pos % 97 = 0),
rec_t0 as (select et.run, contig, et.pos, ref, case when et.pos % 2 = 1 then tla else alt end as alt, packed, 2 * et.pos as seq from et join a1 on et.run = a1.run and et.pos = a1.pos),
rec_t as (select * from rec_t0 union all select run, contig, pos, ref, alt, packed, seq + 1 as seq from rec_t0 where run <> 'clean' and pos % 194 = 0)"""


def arm_sql(gather: str) -> str:
    """Common table expressions rec_c and rec_t (run, contig, pos, ref, alt, packed, seq); gather is the engine's ordered
    string aggregate of {what} by {order}."""
    return f"{entry_sql()},{record_sql(gather)}"


def _both_sql() -> str:
    """arm_sql() for Spark, both arms in a row for each (run, contig, pos, ref): everything is grouped by the order's key, so
    that lineitem and orders are shuffled once, as they stand. An entry's texts are made after the shuffle. Only alternatives
    span the records of a (run, pos). Entries of feature '' have one key here too: 0."""
    return f"""
with e0 as (select *, {_RUN}, row_number() over (partition by {_RUN.removesuffix(' as run')}, l_orderkey order by {_ORDER}) as n from lineitem join orders on l_orderkey = o_orderkey),
e1 as (select * from (select *, row_number() over (partition by run, l_orderkey, l_returnflag, case when l_partkey % 97 = 0 then 0 else l_partkey end order by n) as rep from e0) x where run <> 'clean' or rep = 1),
e2 as (select run, l_orderkey as pos, {_CONTIG}, o_orderstatus as ref, l_returnflag as allele, {_FEATURE}, l_partkey as k, {_CELLS}, n from e1),
g as (select run, contig, pos, ref, collect_set(allele) as alleles, sort_array(collect_list(struct(n, case when {_HAS_C} then {_ENTRY_C} end as c, case when {_HAS_T} then {_ENTRY_T} end as t))) as e,
  count_if({_HAS_C}) as n_c, count_if({_HAS_T}) as n_t from e2 group by run, contig, pos, ref),
h as (select *, sort_array(array_distinct(flatten(collect_list(alleles) over (partition by run, pos)))) as a from g)
select run, contig, pos, ref, n_c, n_t, case when size(a) > 0 then array_join(a, ',') end as alt, case when size(a) > 0 then array_join(reverse(a), ',') end as tla,
  case when exists(e.c, x -> x is not null) then array_join(e.c, ',') end as packed_c, case when exists(e.t, x -> x is not null) then array_join(e.t, ',') end as packed_t from h"""


def _records(both: DataFrame, side: str, alt: str, again: int) -> DataFrame:
    """Records of one arm; those of every again-th position come twice."""
    seq = f"explode(case when run <> 'clean' and pos % {again} = 0 then array(2 * pos, 2 * pos + 1) else array(2 * pos) end) as seq"
    return both.where(f"n_{side} > 0").selectExpr("run", "contig", "pos", "ref", f"{alt} as alt", f"packed_{side} as packed", seq)


#: Where the arms over a folder of tables are stored, by application and folder.
_BUILT: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def arms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(candidate, truth) records, made once in an application for each folder of tables and stored, both in one table of
    which each arm reads its columns."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        store = Store(spark, "arms")
        tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders")}
        widen(spark, tables["lineitem"].count())
        for name, df in tables.items():
            df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name[0]}_orderkey").createOrReplaceTempView(name)
        both = store.put(spark.sql(_both_sql()))
        _BUILT[key] = (_records(both, "c", "alt", 97), _records(both, "t", "case when pos % 2 = 1 then tla else alt end", 194))
    return _BUILT[key]


#: Field lists of the arms, likewise.
_HEADERS: dict[tuple[str, str], DataFrame] = {}


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(side, run, fields) as read from the headers of both arms, written and read once in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HEADERS:
        store = Store(spark, "headers")
        _HEADERS[key] = store.put(_headers(spark, sf_dir, store.path()))
    return _HEADERS[key]


def _headers(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Of a file for each side and run, which declares as many fields as the longest entry of its records has."""
    rows = None
    for side, records_ in zip(NINTH, arms(spark, sf_dir), strict=True):
        longest = F.array_max(F.transform(F.split("packed", ","), lambda e: F.size(F.split(e, r"\|"))))
        n = records_.groupBy("run").agg(F.max(longest).alias("n"))
        names = F.slice(F.array(*map(F.lit, [*KEYS, *FIELDS, NINTH[side]])), F.lit(1), F.col("n"))
        one = n.select(F.lit(side).alias("side"), "run", F.concat(F.lit('##INFO=<ID=CSQ,Number=.,Description="Format: '), F.array_join(names, "|"), F.lit('">')).alias("value"))
        rows = one if rows is None else rows.union(one)
    rows.write.partitionBy("side", "run").text(path)
    found = field_lists(header_catalogue(read_lines(spark, path)))
    return found.select(F.regexp_extract("file", "side=([^/]+)", 1).alias("side"), F.regexp_extract("file", "run=([^/]+)", 1).alias("run"), "fields")
