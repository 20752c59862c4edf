"""Merging shards, their guards, coverage and the reports made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions.cells import CATEGORIES, kind_of, natural_order, pct, rate

#: Join rates from this on are trusted.
FLOOR = 0.99
SUMS = ["aligned", "only_candidate", "only_truth", "malformed_candidate", "malformed_truth", "duplicate_candidate", "duplicate_truth"]
#: What all shards of a run must agree on.
EQUAL = ["cache", "shared_fields", "candidate_only_fields", "truth_only_fields"]


def merge_shards(shards: DataFrame) -> DataFrame:
    """One row per run: counters summed, ratios worked out anew from the sums, contigs and paths of mismatch tables
    collected in order, and what all shards share (see shard_violations)."""
    paths = [F.array_sort(F.collect_list("mismatches")).alias("mismatches")] if "mismatches" in shards.columns else []
    same = [F.max(c).alias(c) for c in (*EQUAL, "status") if c in shards.columns]
    out = shards.groupBy("run").agg(*[F.sum(c).alias(c) for c in SUMS], *same, F.array_join(F.array_sort(F.collect_list("contig")), ",").alias("contigs"), *paths)
    return out.withColumn("join_rate", rate(F.col("aligned"), F.col("aligned") + F.col("only_candidate") + F.col("only_truth")))


def merge_fields(shard_fields: DataFrame) -> DataFrame:
    """(run, field, total, match, categories, pct) from the same by contig."""
    sums = shard_fields.groupBy("run", "field").agg(*[F.sum(c).alias(c) for c in ("total", "match", *CATEGORIES)])
    return sums.withColumn("pct", pct(F.col("match"), F.col("total")))


def merge_samples(samples: DataFrame, cap: int = 15) -> DataFrame:
    """The first cap samples of each (run, field), shards in natural order of their contigs, each in its own order (place)."""
    most = Window.partitionBy("run", "field").orderBy(*natural_order(F.col("contig")), "place")
    return samples.withColumn("__n", F.row_number().over(most)).where(F.col("__n") <= cap).drop("place").withColumnRenamed("__n", "place")


def shard_violations(shards: DataFrame, expected: DataFrame, shard_fields: DataFrame | None = None) -> DataFrame:
    """(run, contig, violation) of what forbids a merge: repeated contigs, shards that aren't ok beside others that are,
    missing and unexpected ones, and (contig null) caches, field counts, one-sided fields or sets of compared fields that
    differ between shards of a run. Runs without any ok shard are stubs and pass. expected: (run, contig)."""
    stubs = shards.groupBy("run").agg(F.count_if(F.col("status") == "ok").alias("n")).where("n = 0").select("run")
    live = shards.join(stubs, "run", "left_anti")
    as_ = lambda df, name: df.select("run", "contig", F.lit(name).alias("violation"))
    out = as_(live.groupBy("run", "contig").count().where("count > 1"), "duplicate")
    out = out.union(as_(live.where("status <> 'ok'"), "failed"))
    out = out.union(as_(expected.join(stubs, "run", "left_anti").join(live, ["run", "contig"], "left_anti"), "missing"))
    out = out.union(as_(live.join(expected, ["run", "contig"], "left_anti"), "unexpected"))
    have = [c for c in EQUAL if c in shards.columns]
    if have:
        kinds = live.groupBy("run").agg(*[F.count_distinct(F.struct(c)).alias(c) for c in have])
        found = F.filter(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in have]), lambda x: x.isNotNull())
        out = out.union(kinds.select("run", F.lit(None).cast("string").alias("contig"), F.explode(found).alias("violation")))
    if shard_fields is not None:
        sets = shard_fields.groupBy("run", "contig").agg(F.array_sort(F.collect_set("field")).alias("fields"))
        differ = sets.groupBy("run").agg(F.count_distinct("fields").alias("n")).where("n > 1")
        out = out.union(differ.select("run", F.lit(None).cast("string").alias("contig"), F.lit("field_set").alias("violation")))
    return out


def required_runs(shards: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, violation): declared runs without a shard, and shards of runs that nobody declared."""
    a, b = shards.select("run").distinct(), runs.select("run").distinct()
    as_ = lambda df, name: df.select("run", F.lit(name).alias("violation"))
    return as_(b.join(a, "run", "left_anti"), "missing_run").union(as_(a.join(b, "run", "left_anti"), "unknown_run"))


def refuse(violations: DataFrame, what: str, shown: int = 20) -> None:
    """Raises if there are any, and names the first."""
    rows = violations.limit(shown).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(tuple(r)) for r in rows))


def merge_checked(shards: DataFrame, shard_fields: DataFrame, expected: DataFrame, runs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """merge_shards() and merge_fields() of shards that no guard refuses."""
    if shards.isEmpty():
        raise ValueError("no shard to merge")
    if runs is not None:
        refuse(required_runs(shards, runs), "runs")
    refuse(shard_violations(shards, expected, shard_fields), "shards can't be merged")
    return merge_shards(shards), merge_fields(shard_fields)


def run_status(shards: DataFrame) -> DataFrame:
    """ok, stub (no shard is ok) or mixed (an error) for each run."""
    bad = F.count_if(F.col("status") != "ok")
    out = shards.groupBy("run").agg(F.count(F.lit(1)).alias("shards"), bad.alias("failed"))
    return out.withColumn("run_status", F.when(F.col("failed") == 0, "ok").when(F.col("failed") == F.col("shards"), "stub").otherwise("mixed"))


def true_concordance(run_field: DataFrame) -> DataFrame:
    """Concordance with expected differences counted as matches."""
    out = run_field.where("total > 0").groupBy("run").agg(F.sum("total").alias("total"), (F.sum("match") + F.sum("flag_expected")).alias("agreed"))
    return out.withColumn("true_pct", pct(F.col("agreed"), F.col("total")))


def coverage(runs: DataFrame, floor: float = FLOOR) -> DataFrame:
    """merge_shards() with warnings (codes, in a fixed order) and trustworthy (no warning). Fields that only one side has
    were never compared, so they warn as well as rows do."""
    fields = [(c, F.size(c) > 0) for c in ("truth_only_fields", "candidate_only_fields") if c in runs.columns]
    checks = [
        ("status", F.col("status") != "ok"),
        ("join_undefined", (F.col("status") == "ok") & F.col("join_rate").isNull()),
        ("join_rate", F.col("join_rate") < floor),
        *[(c, F.col(c) > 0) for c in ("only_truth", "only_candidate", "malformed_candidate", "duplicate_candidate", "malformed_truth", "duplicate_truth")],
        *fields,
    ]
    found = F.filter(F.array(*[F.when(hit, F.lit(code)) for code, hit in checks]), lambda x: x.isNotNull())
    gone = F.col("only_candidate") + F.col("only_truth")
    return runs.withColumns({"warnings": F.array_join(found, ","), "n_warnings": F.size(found).cast("long"), "not_compared": gone, "trustworthy": F.size(found) == 0})


def headline_risk(cov: DataFrame) -> DataFrame:
    """(run, risk): null for a trustworthy run, else what matters most, and how many more warnings there are."""
    first = F.get(F.split("warnings", ","), F.lit(0))
    every = F.col("aligned") + F.col("not_compared")
    line = F.when(F.col("join_rate").isNull(), "join_undefined").when(F.col("not_compared") > 0, F.concat(F.lit("not_compared "), F.col("not_compared").cast("string"), F.lit("/"), every.cast("string"))).otherwise(first)
    more = F.when(F.col("n_warnings") > 1, F.concat(F.lit(" +"), (F.col("n_warnings") - 1).cast("string"), F.lit(" more"))).otherwise("")
    return cov.select("run", F.when(F.col("status") != "ok", F.concat(F.lit("status "), F.col("status"))).when(~F.col("trustworthy"), F.concat(line, more)).alias("risk"))


def overview(runs: DataFrame, run_field: DataFrame, order: list[str]) -> DataFrame:
    """A row per run in the declared order (place): concordance beside its coverage. Ratios of a run that isn't ok are null."""
    totals = run_field.groupBy("run").agg(F.sum("total").alias("total"), F.sum("match").alias("match"))
    cov = coverage(runs).join(headline_risk(coverage(runs)), "run").join(totals.withColumn("overall_pct", pct(F.col("match"), F.col("total"))).select("run", "overall_pct"), "run", "left").join(true_concordance(run_field).select("run", "true_pct"), "run", "left")
    ok = lambda c: F.when(F.col("status") == "ok", F.col(c)).alias(c)
    place = F.array_position(F.array(*map(F.lit, order)), F.col("run"))
    return cov.select(place.alias("place"), "run", "cache", ok("overall_pct"), ok("true_pct"), ok("join_rate"), ok("aligned"), "status", "trustworthy", "risk").orderBy("place", "run")


def category_rollup(run_field: DataFrame) -> DataFrame:
    """Every category with its count over all runs, zero included, from the most severe on."""
    sums = run_field.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in CATEGORIES])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(c).alias("category"), F.col(c).alias("cells")) for i, c in enumerate(CATEGORIES)])
    return sums.select(F.inline(rows)).orderBy("place")


def _by_category() -> Column:
    """The categories that occur and their counts."""
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, CATEGORIES)), F.array(*map(F.col, CATEGORIES))), lambda _, n: n > 0)


def drift_rows(run_field: DataFrame) -> DataFrame:
    """Fields with disagreements, worst first: how many, how many not expected, the commonest category (ties to the more
    severe), counts by category."""
    total = sum((F.col(c) for c in CATEGORIES[1:]), F.col(CATEGORIES[0]))
    best = F.array_max(F.array(*[F.struct(F.col(c).alias("n"), (-F.lit(i)).alias("s"), F.lit(c).alias("c")) for i, c in enumerate(CATEGORIES)]))["c"]
    rows = run_field.withColumn("mismatches", total).where("mismatches > 0")
    real = F.col("mismatches") - F.col("flag_expected")
    rows = rows.select("run", "field", "mismatches", real.alias("real"), pct(F.col("match"), F.col("total")).alias("pct"), best.alias("dominant"), _by_category().alias("by_category"), (real == 0).alias("all_expected"))
    return rows.orderBy("run", F.desc("real"), F.desc("mismatches"), "field")


def worst_fields(drift: DataFrame, samples: DataFrame | None = None, k: int = 24, causes: int = 6, examples: int = 3) -> DataFrame:
    """The k worst fields of each run; the first causes of them with examples: loci, category and both values of the
    first samples."""
    per = Window.partitionBy("run").orderBy(F.desc("real"), F.desc("mismatches"), "field")
    rows = drift.withColumn("place", F.row_number().over(per)).where(F.col("place") <= k)
    if samples is None:
        return rows
    few = samples.where(F.col("place") <= examples).groupBy("run", "field").agg(F.array_sort(F.collect_list(F.struct("place", "locus", "category", "candidate_val", "truth_val"))).alias("e"))
    return rows.join(few, ["run", "field"], "left").withColumn("examples", F.when(F.col("place") <= causes, F.col("e"))).drop("e")


def triage_counts(mismatches: DataFrame) -> DataFrame:
    """(field, category, kind, cells)."""
    return mismatches.groupBy("field", "category", kind_of(F.col("feature")).alias("kind")).agg(F.count(F.lit(1)).alias("cells"))


def triage_rollup(mismatches: DataFrame, first: int = 5) -> DataFrame:
    """(field, total, by_category, by_kind, samples): counts as maps, and the first few rows in natural order. mismatches
    is read twice, so give a stored table."""
    got = triage_counts(mismatches).groupBy("field").agg(F.sum("cells").alias("total"), F.collect_list(F.struct("category", "kind", "cells")).alias("x"))

    def by(name: str) -> Column:
        keys = F.array_sort(F.array_distinct(F.transform("x", lambda e: e[name])))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(F.filter("x", lambda e: e[name] == k), F.lit(0).cast("long"), lambda acc, e: acc + e["cells"])))

    order = ["run", "pos", "ref", "alt", "allele", "feature", "category", "candidate_val", "truth_val"]
    few = Window.partitionBy("field").orderBy(*natural_order(F.col("contig")), *order)
    rows = mismatches.withColumn("n", F.row_number().over(few)).where(F.col("n") <= first)
    shown = rows.groupBy("field").agg(F.array_sort(F.collect_list(F.struct("n", "contig", *order))).alias("samples"))
    return got.select("field", "total", by("category").alias("by_category"), by("kind").alias("by_kind")).join(shown, "field")


def slice_ids(mismatches: DataFrame, field: str, category: str, limit: int | None = 20) -> DataFrame:
    """Distinct features of one slice, in order; the first 20 unless all are asked for."""
    out = mismatches.where((F.col("field") == field) & (F.col("category") == category)).select("feature").distinct().orderBy("feature")
    return out.limit(limit) if limit else out


def fields_moved(run_field: DataFrame, all_fields: bool = False) -> DataFrame:
    """Fields with differing cells, most first within a run: counts, share that is identical, counts by category."""
    moved = run_field.withColumn("moved", F.col("total") - F.col("match"))
    rows = moved if all_fields else moved.where("moved > 0")
    rows = rows.select("run", "field", "moved", "total", pct(F.col("match"), F.col("total")).alias("identical_pct"), _by_category().alias("by_category"))
    return rows.orderBy("run", F.desc("moved"), "field")


def moved_totals(run_field: DataFrame) -> DataFrame:
    """(field, cells) of fields that moved in any run, most first."""
    rows = run_field.groupBy("field").agg(F.sum(F.col("total") - F.col("match")).alias("cells"))
    return rows.where("cells > 0").orderBy(F.desc("cells"), "field")


def structure_violations(runs: DataFrame) -> DataFrame:
    """(run, violation) of runs over which cells can't be summed: not ok, or with annotations of one side only."""
    one_sided = (F.col("only_candidate") > 0) | (F.col("only_truth") > 0) | ~F.col("join_rate").eqNullSafe(F.lit(1.0))
    kind = F.when(F.col("status") != "ok", "status").when(one_sided, "one_sided")
    return runs.select("run", kind.alias("violation")).where("violation is not null")


def moved_summary(runs: DataFrame, run_field: DataFrame) -> DataFrame:
    """(runs, cells, moved, moved_pct) over all runs; cells are aligned annotations by shared fields. Only for runs that
    structure_violations() lets pass."""
    zero = F.lit(0).cast("long")
    cells = runs.select(F.lit(1).alias("runs"), (F.col("aligned") * F.col("shared_fields")).alias("cells"), zero.alias("moved"))
    moved = run_field.join(runs.select("run"), "run", "left_semi").select(F.lit(0).alias("runs"), zero.alias("cells"), (F.col("total") - F.col("match")).alias("moved"))
    sums = cells.union(moved).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("runs", "cells", "moved")])
    return sums.withColumn("moved_pct", F.bround(F.try_divide(F.lit(100.0) * F.col("moved"), F.col("cells")), 6))


def field_matrix(run_field: DataFrame, fields: list[str], value, prefix: str = "") -> DataFrame:
    """A row per run, a column per field (the list is given, so no job looks for it)."""
    return run_field.groupBy("run").agg(*[F.max(F.when(F.col("field") == f, value)).alias(f"{prefix}{f.lower()}") for f in fields])


def attribute_agreement(headers: DataFrame, n_files: int) -> DataFrame:
    """(key, files, vals, verdict, by_value) of header attributes (file, key, value): the same everywhere, only in some
    files, or differing; by_value maps each value to its files."""
    per = headers.groupBy("key", "value").agg(F.array_sort(F.collect_set("file")).alias("in"))
    out = per.groupBy("key").agg(F.collect_list("in").alias("all"), F.count(F.lit(1)).alias("vals"), F.map_from_entries(F.collect_list(F.struct("value", "in"))).alias("by_value"))
    out = out.withColumn("files", F.size(F.array_distinct(F.flatten("all"))).cast("long"))
    verdict = F.when(F.col("vals") > 1, "differs").when(F.col("files") < n_files, "partial").otherwise("same")
    return out.select("key", "files", "vals", verdict.alias("verdict"), "by_value")
