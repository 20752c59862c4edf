"""Count-balanced ranges of positions, their self-check, and what falls into them."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.sources.store import SMALL_ROWS, Store

from .order import next_value, running, with_previous


def _size(n: int, k: int, i: int) -> int:
    """Rows that chunk i of k should have."""
    return n // k + (i < n % k)


def _begin(k: int, i):
    """Rows in the first i of k chunks, as a column; needs total."""
    q, r = F.expr(f"total div {k}"), F.col("total") % k
    return i * q + F.least(i, r)


def _begun(k: int, u):
    """The greatest i for which the first i of k chunks have no more than u rows, as a column; needs total."""
    q, r = F.expr(f"total div {k}"), F.col("total") % k
    early = r * (q + 1)
    late = F.when(q > 0, r + F.floor(F.try_divide(u - early, q))).otherwise(k)
    return F.least(F.when(u < early, F.floor(u / (q + 1))).otherwise(late).cast("long"), F.lit(k).cast("long"))


def _with_spans(counts: DataFrame, spans: DataFrame) -> DataFrame:
    few = spans.select(F.col("contig").alias("__c"), "total", "longest")
    return counts.join(F.broadcast(few), F.col("contig").eqNullSafe(F.col("__c"))).drop("__c")


def _reachable(counts: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """(contig, upto): where a cut can fall at all, and the total. Before cut i at most i runs of equal positions have moved
    it on, so it lies no further behind its target than i times the longest run."""
    i = F.least(_begun(k, F.col("upto")), F.lit(k - 1).cast("long"))
    near = (i > 0) & (F.col("upto") <= _begin(k, i) + i * (F.col("longest") - 1))
    return _with_spans(counts, spans).where((F.col("upto") == F.col("total")) | near).select("contig", "upto", "total")


def _walk(uptos: list[int], total: int, k: int) -> list[int]:
    """The cuts of one contig from all places where they can fall, one after the other."""
    at, out = 0, []
    for i in range(k - 1):
        at = uptos[bisect_left(uptos, min(at + _size(total, k, i), total))]
        out.append(at)
    return out


def _doubled(places: DataFrame, totals: dict[str, int], k: int, store: Store) -> dict[str, list[int]]:
    """The same over tables: the map from a place to the next cut, for both sizes of chunks, is composed with itself, so
    that cuts are looked up in log2(k) steps, each for all that are known."""
    spark = places.sparkSession
    nodes = places.unionByName(places.select("contig", F.lit(0).cast("long").alias("upto"), "total").distinct())
    asked = nodes.select("contig", F.explode(F.array(F.lit(True), F.lit(False))).alias("big"), F.col("upto").alias("x"), "total")
    asked = asked.withColumn("v", F.least(F.col("total"), F.col("x") + F.expr(f"total div {k}") + F.col("big").cast("long")))
    asked = asked.select("contig", "big", "x", "v", F.lit(None).cast("long").alias("u"))
    there = places.select("contig", F.explode(F.array(F.lit(True), F.lit(False))).alias("big"), F.lit(None).cast("long").alias("x"), F.col("upto").alias("v"), F.col("upto").alias("u"))
    step = next_value(asked.union(there).withColumn("known", F.col("u").isNotNull()), ["contig", "big"], ["v", "known"], "u", "y", store)
    steps = [store.put(step.where("x is not null").select("contig", "big", "x", "y"))]
    while 1 << len(steps) < k:
        a, b = steps[-1], steps[-1].select(F.col("contig").alias("c"), F.col("big").alias("g"), F.col("x").alias("from"), F.col("y").alias("to"))
        steps.append(store.put(a.join(b, a.contig.eqNullSafe(b.c) & (a.big == b.g) & (a.y == b["from"])).select("contig", "big", "x", F.col("to").alias("y"))))
    known = {c: {0: 0} for c in totals}
    for big in (True, False):
        for j in reversed(range(len(steps))):
            ends = {c: totals[c] % k if big else k - 1 for c in totals}
            begins = {c: 0 if big else totals[c] % k for c in totals}
            wanted = [(c, i, x) for c in totals for i, x in known[c].items() if begins[c] <= i and i + (1 << j) <= ends[c]]
            if wanted:
                rows = F.broadcast(spark.createDataFrame(wanted, "c string, i long, at long"))
                for r in steps[j].where(F.col("big") == big).join(rows, F.col("contig").eqNullSafe(F.col("c")) & (F.col("x") == F.col("at"))).select("c", "i", "y").collect():
                    known[r["c"]][r["i"] + (1 << j)] = r["y"]
    return {c: [known[c][i] for i in range(1, k)] for c in totals}


def find_cuts(counts: DataFrame, spans: DataFrame, totals: dict[str, int], k: int, sequential: bool, store: Store, small: int = SMALL_ROWS) -> dict[str, list[int]]:
    """The k - 1 cuts of each contig as running counts. A cut never falls between equal positions: it moves on to the
    next position, and where sequential, later cuts move with it.

    Places where cuts can fall are few (see _reachable): up to small of them come to the driver, which walks along them;
    more are composed as tables. counts: (contig, pos, n, upto); spans: (contig, total, longest)."""
    if k == 1:
        return {c: [] for c in totals}
    if sequential:
        places = store.put(_reachable(counts, spans, k))
        if places.count() > small:
            return _doubled(places, totals, k, store)
        found: dict[str, list[int]] = {c: [] for c in totals}
        for r in places.collect():
            found[r["contig"]].append(r["upto"])
        return {c: _walk(sorted(found[c]), totals[c], k) for c in totals}
    upto = F.col("upto")
    passed = _with_spans(counts, spans).withColumns({"i": F.least(_begun(k, upto), F.lit(k - 1).cast("long")), "before": _begun(k, upto - F.col("n"))})
    cuts = {c: [] for c in totals}
    for r in passed.where("i > before").select("contig", "upto").collect():
        cuts[r["contig"]].append(r["upto"])
    return {c: sorted(x) for c, x in cuts.items()}


def input_violations(df: DataFrame, contig: str, pos: str, wanted: DataFrame | None = None, seq: str | None = None, store: Store | None = None) -> DataFrame:
    """(contig, violation, seq, pos, previous) of what ranges can't be cut from: empty for a contig wanted (contig) that has
    no row with a position, and with seq (which needs a store), unsorted for a row whose position is below that of the row
    before it in its contig."""
    rows = df.where(F.col(pos).isNotNull()).select(F.col(contig).alias("contig"), F.col(pos).cast("long").alias("pos"), (F.col(seq) if seq else F.lit(None)).cast("long").alias("seq"))
    none = F.lit(None).cast("long")
    out = rows.limit(0).select("contig", F.lit("").alias("violation"), "seq", "pos", none.alias("previous"))
    if wanted is not None:
        empty = wanted.select("contig").distinct().join(rows.select("contig").distinct(), "contig", "left_anti")
        out = out.union(empty.select("contig", F.lit("empty"), none, none, none))
    if seq is not None:
        back = with_previous(rows, ["contig", "seq"], ["contig", "pos"], "p", store).where(F.col("p").isNotNull() & F.col("p.contig").eqNullSafe(F.col("contig")) & (F.col("pos") < F.col("p.pos")))
        out = out.union(back.select("contig", F.lit("unsorted"), "seq", "pos", "p.pos"))
    return out


def require_countable(df: DataFrame, contig: str, pos: str, wanted: DataFrame | None = None, seq: str | None = None, store: Store | None = None) -> DataFrame:
    """df, if ranges can be cut from it: an empty contig and unsorted input are errors."""
    bad = input_violations(df, contig, pos, wanted, seq, store).orderBy("violation", "contig", "seq").limit(20).collect()
    if empty := [r["contig"] for r in bad if r["violation"] == "empty"]:
        raise ValueError(f"contigs without a position to cut at: {empty}")
    for r in bad[:1]:
        raise ValueError(f"positions of {r['contig']} aren't sorted: {r['previous']}, then {r['pos']}")
    return df


def balanced_ranges(df: DataFrame, contig: str, pos: str, k: int, store: Store, mode: str = "sequential", small: int = SMALL_ROWS) -> DataFrame:
    """(contig, chunk, start, end, n), chunks counted from 0. Rows are summed by position, the sums are added up over
    range partitions, and only rows at a cut are looked at after that. Rows without a contig are a contig of their own."""
    if k < 1:
        raise ValueError("at least one chunk")
    per = df.where(F.col(pos).isNotNull()).groupBy(F.col(contig).alias("contig"), F.col(pos).cast("long").alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    counts = store.put(running(per, ["contig"], ["pos"], "n", "upto", store))
    spans = store.put(counts.groupBy("contig").agg(F.max("upto").alias("total"), F.min("pos").alias("lo"), F.max("n").alias("longest")))
    held = spans.collect()
    totals, lows = {r["contig"]: r["total"] for r in held}, {r["contig"]: r["lo"] for r in held}
    cuts = find_cuts(counts, spans, totals, k, mode == "sequential", store, small)
    bounds = [(c, lows[c], b) for c in cuts for b in sorted({x for x in cuts[c] if 0 < x < totals[c]} | {totals[c]})]
    ends = df.sparkSession.createDataFrame(bounds, "c string, lo long, b long")
    ends = F.broadcast(ends) if len(bounds) <= SMALL_ROWS else ends
    edge = lambda at, last, following: F.struct(at.alias("at"), last.alias("last"), following.alias("next"))
    none, pos_ = F.lit(None).cast("long"), F.col("pos")
    edges = counts.select("contig", F.inline(F.array(edge(F.col("upto"), pos_, none), edge(F.col("upto") - F.col("n"), none, pos_))))
    at = edges.join(ends, F.col("contig").eqNullSafe(F.col("c")) & (F.col("at") == F.col("b")))
    rows = at.groupBy("c", "lo", "b").agg(F.max("last").alias("last"), F.min("next").alias("next"))
    rows = rows.withColumn("end", F.when(F.col("next").isNull(), F.col("last")).otherwise(F.expr("(last + next) div 2")))
    order = Window.partitionBy("c").orderBy("b")
    before = lambda c: F.lag(c).over(order)
    return rows.select(
        F.col("c").alias("contig"),
        (F.row_number().over(order) - 1).alias("chunk"),
        F.coalesce(before("end") + 1, "lo").cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
        (F.col("b") - F.coalesce(before("b"), F.lit(0))).cast("long").alias("n"),
    )


def range_violations(regions: DataFrame, totals: DataFrame) -> DataFrame:
    """(contig, chunk, violation): gaps or overlaps, reversed ranges, counts that don't sum to the total."""
    before = F.lag("end").over(Window.partitionBy("contig").orderBy("chunk"))
    rows = regions.withColumn("before", before)
    gap = rows.where(F.col("before").isNotNull() & (F.col("start") != F.col("before") + 1)).select("contig", "chunk", F.lit("gap").alias("violation"))
    back = rows.where(F.col("start") > F.col("end")).select("contig", "chunk", F.lit("reversed").alias("violation"))
    held = regions.groupBy(F.col("contig").alias("__c")).agg(F.sum("n").alias("n"), F.lit(True).alias("__in"))
    sums = held.join(totals, F.col("__c").eqNullSafe(F.col("contig")), "full_outer").where(~F.col("n").eqNullSafe(F.col("total")))
    return gap.union(back).union(sums.select(F.when(F.col("__in"), F.col("__c")).otherwise(F.col("contig")).alias("contig"), F.lit(None).cast("int").alias("chunk"), F.lit("total").alias("violation")))


def assign_regions(df: DataFrame, regions: DataFrame, small: int = SMALL_ROWS) -> DataFrame:
    """Rows (contig, pos, ...) with the chunk that holds them, a row for each if there are several; null outside all. Up to
    small regions are broadcast. More are dealt in levels by length, doubling from one to the next, and stand in the bins
    of their level that they touch, two at most; rows meet each level by contig and bin, so that a region far longer than
    the others is no more rows than they."""
    r = regions.select(F.col("contig").alias("__c"), "chunk", F.col("start").alias("__a"), F.col("end").alias("__b"))
    inside = F.col("contig").eqNullSafe(F.col("__c")) & F.col("pos").between(F.col("__a"), F.col("__b"))
    if r.limit(small + 1).count() <= small:
        return df.join(F.broadcast(r), inside, "left").drop("__c", "__a", "__b")
    r = r.where("__b >= __a").withColumn("__level", F.ceil(F.log2((F.col("__b") - F.col("__a") + 1).cast("double"))).cast("int"))
    levels = sorted(x["__level"] for x in r.select("__level").distinct().collect())
    if not levels:
        return df.withColumn("chunk", F.lit(None).cast(r.schema["chunk"].dataType))
    out = df
    for level in levels:
        place = lambda c: F.floor(F.shiftright(c, level)) if level < 63 else F.lit(0)  # noqa: B023, E731
        one = F.struct("chunk", F.col("__a").alias("a"), F.col("__b").alias("b"))
        bins = r.where(F.col("__level") == level).withColumn("__bin", F.explode(F.sequence(place(F.col("__a")), place(F.col("__b")))))
        bins = bins.groupBy("__c", "__bin").agg(F.collect_list(one).alias(f"__in{level}"))
        out = out.join(bins, F.col("contig").eqNullSafe(F.col("__c")) & (place(F.col("pos")) == F.col("__bin")), "left").drop("__c", "__bin")
    held = F.flatten(F.filter(F.array(*[F.col(f"__in{x}") for x in levels]), lambda x: x.isNotNull()))
    hits = F.transform(F.filter(held, lambda x: F.col("pos").between(x["a"], x["b"])), lambda x: x["chunk"])
    return out.withColumn("chunk", F.explode_outer(hits)).drop(*[f"__in{x}" for x in levels])


def filter_contig(df: DataFrame, contig: str) -> DataFrame:
    """Rows of one contig, whichever of both spellings they and the argument have: a filter that scans can push down."""
    bare = contig.removeprefix("chr")
    return df.where(F.col("contig").isin(bare, "chr" + bare))


def slice_region(df: DataFrame, contig: str, start: int, end: int) -> DataFrame:
    """Records that start in the closed interval."""
    return filter_contig(df, contig).where(F.col("pos").between(start, end))


def expand_ranges(spec: DataFrame) -> DataFrame:
    """(id, item) of specs such as 1-4,X (id, spec). A spec without an item is an error."""
    parts = F.filter(F.split(F.coalesce("spec", F.lit("")), ","), lambda p: p != "")
    held = F.when(F.size(parts) > 0, parts).otherwise(F.raise_error(F.concat(F.lit("an empty range: "), F.coalesce(F.col("id").cast("string"), F.lit("")))).cast("array<string>"))
    part = spec.select("id", F.explode(held).alias("p"))
    lo, hi = F.regexp_extract("p", r"^(\d+)-(\d+)$", 1), F.regexp_extract("p", r"^(\d+)-(\d+)$", 2)
    items = F.when(F.col("p").rlike(r"^\d+-\d+$"), F.transform(F.sequence(lo.try_cast("long"), hi.try_cast("long")), lambda x: x.cast("string"))).otherwise(F.array("p"))
    return part.select("id", F.explode(items).alias("item")).distinct()


def compress_ranges(items: DataFrame) -> DataFrame:
    """(id, spec) from (id, item): numbers in runs, then other items."""
    number = F.when(F.col("item").rlike("^[0-9]+$"), F.col("item").try_cast("long"))
    rows = items.distinct().withColumn("n", number)
    island = F.col("n") - F.row_number().over(Window.partitionBy("id").orderBy("n"))
    runs = rows.where("n is not null").withColumn("island", island).groupBy("id", "island").agg(F.min("n").alias("a"), F.max("n").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    parts = runs.select("id", F.struct(F.lit(0).alias("k"), F.col("a").alias("n"), text.alias("s")).alias("p"))
    others = rows.where("n is null").select("id", F.struct(F.lit(1).alias("k"), F.lit(None).cast("long").alias("n"), F.col("item").alias("s")).alias("p"))
    return parts.union(others).groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["s"]), ",").alias("spec"))
