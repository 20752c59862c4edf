"""The reconciliation itself: full outer join, cell comparison, classification, concordance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions.cells import CATEGORIES, SENTINELS, classify_expr, locus, natural_order, norm_empty, pct, rate

from .unpack import _SORTED, RECORD, first_wins, parts

KEY = [*RECORD, "allele", "feature"]


def align(candidate: DataFrame, truth: DataFrame) -> DataFrame:
    """Full outer join on the whole key: one shuffle a side, hot positions spread as allele and feature are in the key.
    state: both, candidate or truth."""
    left = candidate.select(*KEY, F.col("alt").alias("alt"), F.col("values").alias("l"))
    right = truth.select(*KEY, F.col("values").alias("r"))
    joined = left.join(right, KEY, "full_outer")
    return joined.withColumn("state", F.when(F.col("l").isNull(), "truth").when(F.col("r").isNull(), "candidate").otherwise("both"))


def match_records(candidate: DataFrame, truth: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """Packed records of both sides, a row for each record key: l_ and r_ with alt, packed (of the first record), n (records
    of the key) and bad (their unusable entries). Each side is shuffled once, before any entry is a row of its own."""

    def side(records: DataFrame, mark: str) -> DataFrame:
        rows = first_wins(records, n_fields, key)
        return rows.select(*_SORTED, *[F.col(f"first.{c}").alias(f"{mark}_{c}") for c in ("alt", "packed")], F.col("n").alias(f"{mark}_n"), F.col("bad").alias(f"{mark}_bad"))

    return side(candidate, "l").join(side(truth, "r"), _SORTED, "full_outer")


def _pairs(n_fields: int, key: tuple[int, int]) -> Column:
    """Entries of both sides of a matched row, paired by allele and feature: (allele, feature, l, r). Sorted by these they
    are neighbours, so that a record with many entries costs a sort of them."""

    def side(packed: str, no: int) -> Column:
        usable = F.filter(parts(n_fields, key, packed), lambda x: ~x["malformed"])
        return F.coalesce(F.transform(usable, lambda x: F.struct(x["allele"].alias("allele"), x["feature"].alias("feature"), F.lit(no).alias("side"), x["entry_no"].alias("entry_no"), x["values"].alias("values"))), F.array())

    same = lambda x, y: (x["allele"] == y["allele"]) & (x["feature"] == y["feature"])
    held = lambda cond: F.coalesce(cond, F.lit(False))
    values = lambda cond, x: F.when(cond, x["values"])

    def firsts(rows: Column) -> Column:
        return F.filter(rows, lambda x, i: ~held(same(x, F.get(rows, i - 1)) & (x["side"] == F.get(rows, i - 1)["side"])))

    def paired(rows: Column) -> Column:
        lone = F.transform(rows, lambda x, i: F.struct(x["allele"].alias("allele"), x["feature"].alias("feature"), values(x["side"] == 0, x).alias("l"), F.when(x["side"] == 1, x["values"]).otherwise(values(held(same(x, F.get(rows, i + 1))), F.get(rows, i + 1))).alias("r"), ((x["side"] == 1) & held(same(x, F.get(rows, i - 1)))).alias("met")))
        return F.filter(lone, lambda x: ~x["met"])

    let = lambda c, f: F.transform(F.array(c), f)[0]
    return let(let(F.sort_array(F.concat(side("l_packed", 0), side("r_packed", 1))), firsts), paired)


def align_matched(matched: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """align() of the annotations of both sides, from match_records(): entries are paired within the row."""
    rows = matched.select(*RECORD, "l_alt", F.explode(_pairs(n_fields, key)).alias("__e"))
    rows = rows.select(*RECORD, F.col("__e.allele").alias("allele"), F.col("__e.feature").alias("feature"), "l_alt", F.col("__e.l").alias("l"), F.col("__e.r").alias("r"))
    state = F.when(F.col("l").isNull(), "truth").when(F.col("r").isNull(), "candidate").otherwise("both")
    return rows.select(*KEY, F.when(F.col("l").isNotNull(), F.col("l_alt")).alias("alt"), "l", "r", state.alias("state"))


def matched_counts(matched: DataFrame, by: tuple[str, ...] = ("run", "contig")) -> DataFrame:
    """unpack.side_counts() of both sides from match_records()."""
    later = lambda c: F.sum(F.coalesce(F.col(c) - 1, F.lit(0)))
    bad = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return matched.groupBy(*by).agg(bad("l_bad").alias("malformed_candidate"), later("l_n").alias("duplicate_candidate"), bad("r_bad").alias("malformed_truth"), later("r_n").alias("duplicate_truth"))


def store_bucketed(annotations: DataFrame, table: str, buckets: int, path: str) -> DataFrame:
    """Annotations as a table in buckets of the whole key, sorted within, its files at path. align() reads it without
    shuffling it, in any number of runs, if buckets is at least the session's number of shuffle partitions."""
    columns = [*KEY, "values"]
    annotations.select(*columns).repartition(buckets, *KEY).write.bucketBy(buckets, *KEY).sortBy(*KEY).format("parquet").option("path", path).saveAsTable(table)
    return annotations.sparkSession.table(table)


def coverage_counts(joined: DataFrame, by: tuple[str, ...] = ("run",)) -> DataFrame:
    count = lambda s: F.count_if(F.col("state") == s)
    return joined.groupBy(*by).agg(count("both").alias("aligned"), count("candidate").alias("only_candidate"), count("truth").alias("only_truth"))


def _cells(fields: list[str], sentinels) -> list[Column]:
    """A cell of a joined row for each field: (field, cv, tv), null where both sides agree. Plain expressions, which are
    compiled; functions of lambdas aren't."""
    at = lambda side, i: F.get(side, F.lit(i))
    differs = lambda i: norm_empty(at("l", i), sentinels) != norm_empty(at("r", i), sentinels)
    return [F.when(differs(i), F.struct(F.lit(name).alias("field"), at("l", i).alias("cv"), at("r", i).alias("tv"))) for i, name in enumerate(fields)]


def _category(flags: dict[str, list[str]], needs: dict[str, str], sentinels) -> Column:
    have = F.array().cast("array<string>")
    for run, on in flags.items():
        have = F.when(F.col("run") == run, F.array(*map(F.lit, on)).cast("array<string>")).otherwise(have)
    return classify_expr(F.col("field"), have, F.col("candidate_val"), F.col("truth_val"), needs, sentinels=sentinels)


def cell_mismatches(joined: DataFrame, fields: list[str], flags: dict[str, list[str]], needs: dict[str, str], sentinels=SENTINELS) -> DataFrame:
    """A row per disagreeing cell. Arrays are compared in place and only disagreements are exploded."""
    rows = joined.where("state = 'both'").select(*KEY, "alt", F.explode(F.array(*_cells(fields, sentinels))).alias("c")).where("c is not null")
    rows = rows.select(*KEY, "alt", F.col("c.field").alias("field"), F.col("c.cv").alias("candidate_val"), F.col("c.tv").alias("truth_val"))
    return rows.withColumn("category", _category(flags, needs, sentinels))


def tally(joined: DataFrame, fields: list[str], flags: dict[str, list[str]], needs: dict[str, str], by: tuple[str, ...] = ("run", "contig"), sentinels=SENTINELS) -> DataFrame:
    """(by, field, category, n): how many cells of each field fall into each category and, where field is null, how many
    annotations into each state. Everything that reports count comes from this small table, so that the join is
    evaluated once."""
    one = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("cv"), F.lit(None).cast("string").alias("tv"))
    rows = joined.select(*by, "state", F.explode(F.array(one, *_cells(fields, sentinels))).alias("c")).where("c is not null")
    rows = rows.select(*by, "state", F.col("c.field").alias("field"), F.col("c.cv").alias("candidate_val"), F.col("c.tv").alias("truth_val"))
    category = F.when(F.col("field").isNull(), F.col("state")).otherwise(_category(flags, needs, sentinels))
    return rows.groupBy(*by, "field", category.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def tallied_coverage(counted: DataFrame, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """coverage_counts() from a tally."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("category") == s, F.col("n"))), F.lit(0))
    return counted.where("field is null").groupBy(*by).agg(n("both").alias("aligned"), n("candidate").alias("only_candidate"), n("truth").alias("only_truth"))


def per_field(counted: DataFrame, aligned: DataFrame, fields: list[str], by: tuple[str, ...] = ("run",)) -> DataFrame:
    """(run, field, total, match, one count for each category) from a tally. Every aligned annotation counts for every
    field, so that totals come from the aligned counts and no matching cell is ever made a row."""
    n = lambda c: F.sum(F.when(F.col("category") == c, F.col("n")))
    found = counted.where("field is not null").groupBy(*by, "field").agg(F.sum("n").alias("bad"), *[n(c).alias(c) for c in CATEGORIES])
    grid = aligned.select(*by, "aligned", F.explode(F.array(*map(F.lit, fields))).alias("field"))
    rows = grid.join(found, [*by, "field"], "left").fillna(0, ["bad", *CATEGORIES])
    return rows.select(*by, "field", F.col("aligned").alias("total"), (F.col("aligned") - F.col("bad")).alias("match"), *CATEGORIES)


def overall(run_field: DataFrame) -> DataFrame:
    out = run_field.groupBy("run").agg(F.sum("total").alias("total"), F.sum("match").alias("match"))
    return out.withColumn("overall_pct", pct(F.col("match"), F.col("total")))


def join_rate(counts: DataFrame) -> DataFrame:
    every = F.col("aligned") + F.col("only_candidate") + F.col("only_truth")
    return counts.withColumn("join_rate", rate(F.col("aligned"), every))


def samples(mismatches: DataFrame, per: int = 5, cap: int = 15) -> DataFrame:
    """The first few of each (run, contig, field, category), and of these the first of each (run, field), contigs in
    natural order; locus names the place."""
    order = ["pos", "ref", "alt", "allele", "feature"]
    few = Window.partitionBy("run", "contig", "field", "category").orderBy(*order)
    most = Window.partitionBy("run", "field").orderBy(*natural_order(F.col("contig")), *order, "category")
    rows = mismatches.withColumn("n", F.row_number().over(few)).where(F.col("n") <= per)
    rows = rows.withColumn("place", F.row_number().over(most)).where(F.col("place") <= cap)
    return rows.withColumn("locus", locus(*map(F.col, ("contig", "pos", "ref", "alt", "allele", "feature")))).drop("n", "alts")
