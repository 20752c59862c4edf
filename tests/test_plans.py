"""Plans and order: first-wins without windows, buckets, one exchange, cuts by doubling, null groups, batches."""

import random

import pytest
from pyspark.sql import functions as F

from concord.operators import audit, diff, order, ranges, unpack
from concord.plans import arms, queries
from concord.sources.store import Store, widen
from concord.streaming.resume import Incremental

RECORDS = "run string, contig string, pos long, ref string, alt string, packed string, seq long"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=3000):
    """A third of all records have one key; entries repeat within records, some lack their key."""
    rng = random.Random(n)
    rows = [("r", "chr1", 7 if i % 3 == 0 else i, "A", rng.choice(["C,T", "T,C"]), ",".join(rng.choice(["C|f1|a", "T|f2|b", "C|f1|z", "C", "|f3|", "T||q", "C|f1"]) for _ in range(rng.randrange(1, 6))), i * 3 % 3001) for i in range(n)]
    return rows, spark.createDataFrame(rows, RECORDS)


def test_first_wins_with_a_hot_key(spark):
    rows, df = hot(spark)
    got = unpack.unpacked(df, 3)
    assert "Window" not in plan(got) and "Window" not in plan(unpack.first_records(unpack.keyed(df))[0])
    want, seen = [], {}
    for r in sorted(rows, key=lambda r: r[6]):
        later = seen.setdefault(r[2], r[6]) != r[6]
        inner = set()
        for i, e in enumerate(r[5].split(",")):
            p = e.split("|")
            key = (p[0], p[1]) if len(p) > 1 else None
            want.append((r[2], r[6], i, later, key is None, key is not None and key in inner))
            inner.add(key)
    mine = [(r["pos"], r["seq"], r["entry_no"], r["later_record"], r["malformed"], r["surplus"]) for r in got.collect()]
    assert sorted(mine) == sorted(want)
    kept = unpack.annotations(got).collect()
    assert len(kept) == sum(not (w[3] or w[4] or w[5]) for w in want) and sum(r["pos"] == 7 for r in kept) <= 5


def test_packed_records_are_matched_as_annotations_are(spark):
    """Matched records give what the join of annotations gives, with hot keys, repeated entries and one-sided records; each
    side is shuffled once, and the join adds no sort."""
    rows, a = hot(spark)
    rng = random.Random(1)
    b = spark.createDataFrame([(*r[:5], ",".join(rng.sample(r[5].split(","), len(r[5].split(",")))) + ",T|late|v", r[6]) for r in rows if r[2] % 5], RECORDS)
    b = b.union(spark.createDataFrame([("r", "2", 9, "A", "T", "T|f2|b", 1), ("r", "2", 9, "A", "T", "T|f2|z", 0), ("r", "2", 8, "A", "T", "T", 5), ("r", "2", 8, None, "T", "T|f|a", 5)], RECORDS))
    matched = diff.match_records(a, b, 3)
    text = matched._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2
    want = diff.align(*(unpack.annotations(unpack.unpacked(x, 3)) for x in (a, b)))
    got = diff.align_matched(matched, 3)
    assert got.columns == want.columns
    both = lambda df: sorted(map(str, df.collect()))
    assert both(got) == both(want)
    counts = unpack.side_counts(unpack.unpacked(a, 3), "candidate", ("run", "contig")).join(unpack.side_counts(unpack.unpacked(b, 3), "truth", ("run", "contig")), ["run", "contig"], "full_outer").fillna(0)
    names = ["run", "contig", "malformed_candidate", "duplicate_candidate", "malformed_truth", "duplicate_truth"]
    assert both(diff.matched_counts(matched).select(*names)) == both(counts.select(*names))
    kept = ["run", "contig", "pos", "ref", "alt", "allele", "feature", "values"]
    assert both(unpack.first_annotations(b, 3).select(*kept)) == both(unpack.annotations(unpack.unpacked(b, 3)).select(*kept))
    assert both(unpack.bad_counts(b, 3)) == both(unpack.malformed_counts(unpack.unpacked(b, 3)))
    other = lambda df: df.withColumn("packed", F.transform(F.split("packed", ","), lambda e: F.concat(F.lit("x|"), e)).cast("array<string>")).withColumn("packed", F.array_join("packed", ","))
    assert both(unpack.bad_counts(other(b), 4, (1, 2))) == both(unpack.bad_counts(b, 3))


def test_shuffle_partitions_follow_the_rows(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        widen(spark, 100)
        assert spark.conf.get(name) == before
        widen(spark, 216_000_000)
        assert spark.conf.get(name) == "864"
    finally:
        spark.conf.set(name, before)


def test_arms_are_made_in_one_shuffle_of_each_table(spark, monkeypatch):
    """Windows and groups use the deal of the join."""
    plans = []
    put = Store.put
    monkeypatch.setattr(Store, "put", lambda self, df: plans.append(plan(df)) or put(self, df))
    monkeypatch.setattr(arms, "_BUILT", {})
    assert arms.arms(spark, "/root/testdata/sf0.001")[0].count() > 0
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 2


def test_bucketed_truth_is_not_shuffled_again(spark, tmp_path):
    _, df = hot(spark, 300)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = unpack.annotations(unpack.unpacked(df, 3))
    truth = diff.store_bucketed(rows, "bucketed_truth_test", n, str(tmp_path / "t"))
    try:
        off = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
        before = {k: spark.conf.get(k) for k in off}
        spark.conf.set(off[0], "false")
        spark.conf.set(off[1], "-1")
        for run in ("r", "other"):
            joined = diff.align(spark.createDataFrame(rows.where(F.col("pos") % 2 == 0).collect(), rows.schema), truth)
            text = joined._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange") == 1
            assert joined.where("state = 'both'").count() > 0 and joined.count() == rows.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("drop table bucketed_truth_test")


def test_key_sets_in_one_exchange(spark):
    a, b = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("a", 1), (None, 2), ("c", 3)], [("a", 1), (None, 2), ("d", None)]))
    counts, left, right = audit.compare_keys(a, b, ["k", "v"])
    assert tuple(counts.first()) == (3, 3, 2, 1, 1, False)
    assert [tuple(r) for r in left.collect()] == [("c", 3)] and [tuple(r) for r in right.collect()] == [("d", None)]
    assert left._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert tuple(audit.compare_keys(a, a.limit(0), ["k"], Store(spark, "t"))[0].first()) == (3, 0, 0, 3, 0, False)


def walk(positions, k):
    """Sizes of chunks, one row after the other."""
    p, n = sorted(positions), len(positions)
    cuts, at = [], 0
    for i in range(k - 1):
        at = min(n, at + n // k + (i < n % k))
        while 0 < at < n and p[at - 1] == p[at]:
            at += 1
        cuts.append(at)
    edges = sorted({x for x in cuts if 0 < x < n} | {n})
    return [b - a for a, b in zip([0, *edges], edges)]


@pytest.mark.parametrize("small", [100_000, 0])
def test_cuts_by_doubling_equal_the_walk(spark, monkeypatch, small):
    """Heavy ties, 64 chunks, rows without a contig; with small 0 the map is composed as a table."""
    steps = []
    put = Store.put
    monkeypatch.setattr(Store, "put", lambda self, df: steps.append(1) or put(self, df))
    rng = random.Random(9)
    contigs = {"a": [rng.randrange(1, 200) for _ in range(3000)], None: [rng.randrange(1, 40) for _ in range(500)], "c": [5] * 70, "d": list(range(200)), "e": [1, 1, 2]}
    df = spark.createDataFrame([(c, p) for c, ps in contigs.items() for p in ps], "c string, p long")
    found = ranges.balanced_ranges(df, "c", "p", 64, Store(spark, "t"), small=small)
    passes = len(steps)
    rows = found.collect()
    for c, ps in contigs.items():
        assert [r["n"] for r in sorted((r for r in rows if r["contig"] == c), key=lambda r: r["chunk"])] == walk(ps, 64), c
    assert passes <= 5 + 3 + 6
    totals = df.groupBy(F.col("c").alias("contig")).agg(F.count("*").alias("total"))
    assert ranges.range_violations(found, totals).isEmpty()
    placed = ranges.assign_regions(df.select(F.col("c").alias("contig"), F.col("p").alias("pos")), found)
    assert placed.where("chunk is null").isEmpty()


def test_regions_of_very_different_lengths(spark):
    """Regions that overlap, of one position and of a whole contig; nothing is dealt in bins of their mean length."""
    rng = random.Random(4)
    regions = [("1", 0, 1, 10**9), ("1", 1, 5, 5), (None, 2, 3, 90), ("2", 3, 8, 7)] + [("1", 4 + i, 100 * i, 100 * i + rng.randrange(0, 150)) for i in range(200)]
    rows = [(rng.choice(["1", "1", "2", None]), rng.choice([None, 5, rng.randrange(0, 25_000), 10**9, 10**9 + 1])) for _ in range(800)]
    a, b = spark.createDataFrame(rows, "contig string, pos long"), spark.createDataFrame(regions, "contig string, chunk int, start long, end long")
    want = [(c, p, k) for c, p in rows for k in ([k for d, k, lo, hi in regions if d == c and p is not None and lo <= p <= hi] or [None])]
    for small in (1000, 3):
        assert sorted(map(tuple, ranges.assign_regions(a, b, small).collect()), key=str) == sorted(want, key=str)


def test_ranges_refuse_empty_and_unsorted_contigs(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("b", None, 3), ("a", 3, 4)], "c string, p long, s long")
    ranges.require_countable(df, "c", "p", spark.createDataFrame([("a",)], "contig string"), "s", Store(spark, "t"))
    with pytest.raises(ValueError, match="without a position.*'b', 'z'"):
        ranges.require_countable(df, "c", "p", spark.createDataFrame([("b",), ("z",)], "contig string"))
    with pytest.raises(ValueError, match="positions of a aren't sorted: 3, then 2"):
        ranges.require_countable(df.union(spark.createDataFrame([("a", 2, 5), ("b", 1, 6)], df.schema)), "c", "p", seq="s", store=Store(spark, "t"))


def test_next_value_over_range_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), i, i if rng.random() < 0.1 else None) for i in range(400)]
    got = order.next_value(spark.createDataFrame(rows, "g string, o int, v int").repartition(5), ["g"], ["o"], "v", "x", Store(spark, "t"))
    for r in got.collect():
        assert r["x"] == next((v for g, o, v in rows if g == r["g"] and o >= r["o"] and v is not None), None)


def test_positions_of_null_contigs_and_of_unequal_bodies(spark):
    body = lambda *rows: spark.createDataFrame([(c, i, t) for i, (c, t) in enumerate(rows)], "contig string, seq long, line string")
    a = body((None, "x;v=1"), (None, "y"), ("1", "z"), ("1", None))
    b = body((None, "x"), (None, "Y"), ("1", "z"), ("1", None))
    got = {r["contig"]: (r["lines"], r["raw"], r["residual"], r["first"]) for r in audit.positional_residual(a, b, ";v=1", Store(spark, "t")).collect()}
    assert got == {None: (2, 2, 1, [2]), "1": (2, 0, 0, None)}
    longer = b.union(spark.createDataFrame([("1", 9, "w")], b.schema))
    with pytest.raises(ValueError, match="1: 2 and 3 lines"):
        audit.positional_residual(a, longer, ";v=1", Store(spark, "t"))
    free = audit.positional_residual(a, longer, ";v=1", Store(spark, "t"), require_equal=False)
    assert {r["contig"]: r["residual"] for r in free.collect()} == {None: 1, "1": 1}


def test_planned_concat(spark):
    shards = spark.createDataFrame([(c, k, s) for c in ("10", "2", "X") for k in (0, 11, 2) for s in (2, 1)], "contig string, chunk int, seq int")
    plan_ = spark.createDataFrame([("10", 0), ("10", 11), ("2", 11), ("2", 2), ("X", 0), ("7", 1), ("X", 0)], "contig string, chunk int")
    rows, integrity = audit.concat_planned(plan_, shards)
    assert [tuple(r) for r in rows.collect()] == [("2", 2, 1), ("2", 2, 2), ("2", 11, 1), ("2", 11, 2), ("10", 0, 1), ("10", 0, 2), ("10", 11, 1), ("10", 11, 2), ("X", 0, 1), ("X", 0, 2)]
    assert {(r["contig"], r["chunk"]): r["state"] for r in integrity.where("state <> 'ok'").collect()} == {("X", 0): "repeated", ("7", 1): "missing", ("10", 2): "unplanned", ("2", 0): "unplanned", ("X", 11): "unplanned", ("X", 2): "unplanned"}
    with pytest.raises(ValueError, match="7, chunk 1: missing; X, chunk 0: repeated"):
        audit.require_planned(integrity)
    with pytest.raises(ValueError, match="lists no shard"):
        audit.concat_planned(plan_.limit(0), shards)


def test_lookup_makes_no_rows(spark):
    df = spark.createDataFrame([("r", "chr1", 5, "A", "C", "C|f|1,C|g|2,C|g|3", 1), ("r", "1", 6, "A", "C", "C|g", 2), ("r", "1", 7, "A", "C", "C|h|1", 3), ("r", "1", 8, "A", "C", None, 4)], RECORDS)
    at = spark.createDataFrame([("chr1", 5), ("1", 7), ("2", 6)], "contig string, pos long")
    found = unpack.lookup(df, "C", "g", 3)
    assert "Generate" not in plan(found)
    assert sorted((r["pos"], r["values"]) for r in found.collect()) == [(5, ["2"]), (6, [""])]
    assert [r["pos"] for r in unpack.lookup(df, "C", "g", 3, at).collect()] == [5]


def test_shards_as_they_land(spark, tmp_path):
    """Batches add up to the whole; one that runs again, or a shard that lands again, changes what it should only."""
    rng = random.Random(1)
    record = lambda c, i, x: ("r", c, i, "A", "C", f"C|f{i}|{x}", i)
    truth = spark.createDataFrame([record(c, i, i % 3) for c in "123" for i in range(30)], RECORDS)
    side = {c: [record(c, i, rng.randrange(3)) for i in range(28)] for c in "123"}
    landing, target, check = (str(tmp_path / x) for x in ("landing", "target", "check"))
    going = Incremental(truth, target, 3, ["F"], {"r": []}, {})
    land = lambda c, rows: spark.createDataFrame(rows, RECORDS).coalesce(1).write.mode("append").parquet(landing)
    whole = lambda: diff.tally(diff.align(*[unpack.annotations(unpack.unpacked(x, 3)) for x in (spark.createDataFrame([r for rows in side.values() for r in rows], RECORDS), truth)]), ["F"], {"r": []}, {})
    shown = lambda df: sorted(map(tuple, df.collect()), key=str)
    land("1", side["1"])
    land("2", side["2"])
    going.run(landing, RECORDS, check, files=1)
    assert {r["contig"] for r in going.tally().collect()} == {"1", "2"}
    land("3", side["3"])
    going.run(landing, RECORDS, check, files=1)
    assert shown(going.tally().select(whole().columns)) == shown(whole())
    going.batch(spark.createDataFrame(side["3"], RECORDS), 2)
    assert shown(going.tally().select(whole().columns)) == shown(whole())
    side["2"] = [record("2", i, i % 3) for i in range(30)]
    land("2", side["2"])
    going.run(landing, RECORDS, check)
    assert shown(going.tally().select(whole().columns)) == shown(whole())


def test_shards_in_parts(spark, tmp_path):
    """Parts of a shard in several batches, a call that fails midway, batches run again, shards of the truth alone, null
    contigs, and a shard that lands again without an annotation: each time as the whole tables give it."""
    record = lambda c, i, x: ("r", c, i, "A", "C", f"C|f{i}|{x}", i)
    truth = spark.createDataFrame([record(c, i, i % 3) for c in ("1", "2", "3", "4", None) for i in range(12)], RECORDS)
    side = {"1": [record("chr1" if i % 2 else "1", i, i % 2) for i in range(11)], "2": [record("2", i, 0) for i in range(3, 9)], "3": [record("3", i, 1) for i in range(9)], None: [record(None, i, 0) for i in range(4)]}
    landing, target, check = (str(tmp_path / x) for x in ("landing", "target", "check"))
    land = lambda rows: spark.createDataFrame(rows, RECORDS).coalesce(1).write.mode("append").parquet(landing)
    shown = lambda df: sorted(map(tuple, df.select("run", "contig", "field", "category", "n").collect()), key=str)

    def whole(*contigs):
        c = spark.createDataFrame([r for rows in side.values() for r in rows], RECORDS)
        rows = shown(diff.tally(diff.align_matched(diff.match_records(c, truth, 3), 3), ["F"], {"r": []}, {}))
        return [r for r in rows if not contigs or r[1] in contigs]

    class Failing(Incremental):
        def batch(self, candidate, number):
            super().batch(candidate, number)
            if number == 2:
                raise RuntimeError("midway")

    make = lambda kind: kind(truth, target, 3, ["F"], {"r": []}, {})
    with pytest.raises(ValueError, match="no batch"):
        make(Incremental).again(landing, RECORDS)
    for rows in (side["1"][:4], side["2"] + side["1"][4:5], side["1"][5:], side["3"], side[None]):
        land(rows)
    with pytest.raises(Exception, match="midway"):
        make(Failing).run(landing, RECORDS, check, files=1)
    going = make(Incremental)
    going.run(landing, RECORDS, check, files=1)
    assert shown(going.tally()) == whole("1", "2", "3", None)
    assert shown(going.tally(rest=True)) == whole()
    for number in (1, None):
        going.again(landing, RECORDS, number)
        assert shown(going.tally(rest=True)) == whole()
    side["2"] = [(*r[:5], None, r[6]) for r in side["2"]]
    land(side["2"])
    side["3"] = side["3"][:2]
    land(side["3"])
    going.run(landing, RECORDS, check, files=1)
    going.run(landing, RECORDS, check, files=1)
    assert shown(going.tally(rest=True)) == whole()
    (min((tmp_path / "landing").glob("part-*"), key=lambda p: p.stat().st_mtime_ns)).unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        going.again(landing, RECORDS, 0)


def test_incremental_fields_takes_every_step(spark, tmp_path, monkeypatch):
    """Two deliveries, the last batch run again, and a run that only the truth has."""
    li = [(i, 103 if i % 3 == 1 else i * 7, i % 3, 1, float(i % 50), i * 1.5, 0.05, 0.02, "NRA"[i % 3], "OF"[i % 2], None) for i in range(90)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, "OFP"[i % 3]) for i in range(90)], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    taken, put = [], Incremental.batch
    monkeypatch.setattr(Incremental, "batch", lambda self, df, number: (taken.append(number), put(self, df, number))[1])
    got = queries.incremental_fields(spark, str(tmp_path))
    want = queries.per_field_concordance(spark, str(tmp_path)).drop("pct")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {(r["run"], r["total"] > 0) for r in got.collect()} == {("clean", True), ("m", False), ("m_am", True)}
    assert len(taken) > 2 and taken[-2:] == [max(taken)] * 2
