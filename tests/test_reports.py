"""Merging, guards, coverage and reports, with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from concord.functions.cells import CATEGORIES
from concord.operators import audit, order, summary
from concord.sources import records
from concord.sources.store import Store

SHARD = "run string, contig string, " + ", ".join(f"{c} long" for c in summary.SUMS) + ", status string, cache string, shared_fields int, candidate_only_fields array<string>, truth_only_fields array<string>, mismatches string"
FIELD = "run string, contig string, field string, total long, match long, " + ", ".join(f"{c} long" for c in CATEGORIES)


def shard(run, contig, aligned=10, oc=0, ot=0, mal=(0, 0), dup=(0, 0), status="ok", cache="k", shared=1, co=(), to=()):
    return (run, contig, aligned, oc, ot, *mal, *dup, status, cache, shared, list(co), list(to), f"{run}/{contig}")


def field(run, contig, name="S", total=10, **cats):
    return (run, contig, name, total, total - sum(cats.values()), *(cats.get(c, 0) for c in CATEGORIES))


def tables(spark, shards, fields=()):
    return spark.createDataFrame(shards, SHARD), spark.createDataFrame(list(fields) or [field(s[0], s[1]) for s in shards], FIELD)


def test_merge_recomputes_ratios(spark):
    shards, fields = tables(spark, [shard("r", "2", 1, ot=100), shard("r", "1", 1)], [field("r", "1", total=6, truth_only=1), field("r", "2", total=4, value_diff=1)])
    runs, by_field = summary.merge_checked(shards, fields, shards.select("run", "contig"))
    r, f = runs.first(), by_field.first()
    assert (r["join_rate"], r["contigs"], r["mismatches"], r["only_truth"]) == (0.0196, "1,2", ["r/1", "r/2"], 100)
    assert (f["total"], f["match"], f["pct"], f["truth_only"], f["value_diff"]) == (10, 8, 80.0, 1, 1)
    none = summary.merge_shards(tables(spark, [shard("r", "1", 0), shard("r", "2", 0)])[0]).first()
    assert none["join_rate"] is None


@pytest.mark.parametrize(
    "bad,fields,what",
    [
        ([shard("r", "1"), shard("r", "2"), shard("r", "2")], (), "duplicate"),
        ([shard("r", "1"), shard("r", "2", status="failed")], (), "failed"),
        ([shard("r", "1")], (), "missing"),
        ([shard("r", "1"), shard("r", "2"), shard("r", "3")], (), "unexpected"),
        ([shard("r", "1"), shard("r", "2", cache="other")], (), "cache"),
        ([shard("r", "1"), shard("r", "2", shared=2)], (), "shared_fields"),
        ([shard("r", "1"), shard("r", "2", co=["X"])], (), "candidate_only_fields"),
        ([shard("r", "1"), shard("r", "2", to=["X"])], (), "truth_only_fields"),
        ([shard("r", "1"), shard("r", "2")], [field("r", "1"), field("r", "2"), field("r", "2", "T")], "field_set"),
    ],
)
def test_guards_refuse(spark, bad, fields, what):
    shards, by_field = tables(spark, bad, fields)
    expected = spark.createDataFrame([("r", "1"), ("r", "2")], "run string, contig string")
    with pytest.raises(ValueError, match=what):
        summary.merge_checked(shards, by_field, expected)


def test_runs_and_stubs(spark):
    shards, by_field = tables(spark, [shard("r", "1"), shard("stub", None, status="no_gt")])
    expected = spark.createDataFrame([("r", "1"), ("stub", "1")], "run string, contig string")
    runs, _ = summary.merge_checked(shards, by_field, expected)
    assert {r["run"]: r["status"] for r in runs.collect()} == {"r": "ok", "stub": "no_gt"}
    with pytest.raises(ValueError, match="unknown_run"):
        summary.merge_checked(shards, by_field, expected, spark.createDataFrame([("r",)], "run string"))
    with pytest.raises(ValueError, match="missing_run"):
        summary.merge_checked(shards, by_field, expected, spark.createDataFrame([("r",), ("stub",), ("gone",)], "run string"))
    with pytest.raises(ValueError, match="no shard"):
        summary.merge_checked(shards.limit(0), by_field, expected)


def test_coverage_warns_of_all_that_was_not_compared(spark):
    shards, _ = tables(
        spark,
        [
            shard("a", "1", 99, ot=1),
            shard("b", "1", 9, oc=1, mal=(1, 2), dup=(3, 4)),
            shard("c", "1", co=["X"], to=["Y", "Z"]),
            shard("d", "1", 0),
            shard("e", "1", status="no_gt"),
            shard("f", "1"),
        ],
    )
    cov = summary.coverage(summary.merge_shards(shards))
    got = {r["run"]: (r["warnings"], r["trustworthy"]) for r in cov.collect()}
    assert got == {
        "a": ("only_truth", False),
        "b": ("join_rate,only_candidate,malformed_candidate,duplicate_candidate,malformed_truth,duplicate_truth", False),
        "c": ("truth_only_fields,candidate_only_fields", False),
        "d": ("join_undefined", False),
        "e": ("status", False),
        "f": ("", True),
    }
    risk = {r["run"]: r["risk"] for r in summary.headline_risk(cov).collect()}
    assert risk == {"a": "not_compared 1/100", "b": "not_compared 1/10 +5 more", "c": "truth_only_fields +1 more", "d": "join_undefined", "e": "status no_gt", "f": None}


def test_severity_decides_order_and_ties(spark):
    _, f = tables(spark, [], [field("r", "1", "A", 100, truth_only=25, value_diff=5), field("r", "1", "B", 100, value_diff=3, candidate_only=3), field("r", "1", "C", 100, flag_expected=50), field("r", "1", "D", 100)])
    runs = summary.merge_fields(f)
    assert [r["category"] for r in summary.category_rollup(runs).collect()] == ["truth_only", "value_diff", "candidate_only", "order_diff", "numeric_tol", "flag_expected"]
    rows = summary.drift_rows(runs).collect()
    assert [(r["field"], r["mismatches"], r["real"], r["dominant"], r["all_expected"]) for r in rows] == [("A", 30, 30, "truth_only", False), ("B", 6, 6, "value_diff", False), ("C", 50, 0, "flag_expected", True)]
    assert rows[0]["by_category"] == {"truth_only": 25, "value_diff": 5}
    assert [(r["field"], r["cells"]) for r in summary.moved_totals(runs).collect()] == [("C", 50), ("A", 30), ("B", 6)]
    assert [r["field"] for r in summary.fields_moved(runs, all_fields=True).collect()] == ["C", "A", "B", "D"]


def test_moved_cells_need_one_structure(spark):
    shards, f = tables(spark, [shard("a", "1", shared=2), shard("b", "1", ot=1), shard("c", "1", status="no_gt")], [field("a", "1", "A", value_diff=1), field("a", "1", "B"), field("b", "1")])
    runs = summary.merge_shards(shards)
    assert {(r["run"], r["violation"]) for r in summary.structure_violations(runs).collect()} == {("b", "one_sided"), ("c", "status")}
    assert tuple(summary.moved_summary(runs.where("run = 'a'"), summary.merge_fields(f)).first()) == (1, 20, 1, 5.0)
    assert [tuple(r)[:3] for r in summary.overview(runs, summary.merge_fields(f), ["c", "b", "a"]).collect()] == [(1, "c", "k"), (2, "b", "k"), (3, "a", "k")]


def test_triage(spark):
    rows = [("r", "10", i, "A", "T", ["T"], "T", f, "S", "x", "y", c) for i, (f, c) in enumerate([("ENST1", "value_diff"), ("NM_1", "value_diff"), ("", "truth_only"), ("Q", "value_diff"), ("XR_2", "order_diff")])]
    rows += [("r", "2", 9, "A", "T", ["T"], "T", "ENST9", "S", "x", "y", "value_diff")]
    m = spark.createDataFrame(rows, "run string, contig string, pos long, ref string, alt string, alts array<string>, allele string, feature string, field string, candidate_val string, truth_val string, category string")
    r = summary.triage_rollup(m).first()
    assert (r["total"], r["by_category"], r["by_kind"]) == (6, {"value_diff": 4, "truth_only": 1, "order_diff": 1}, {"ENSEMBL": 2, "REFSEQ": 2, "NONE": 1, "OTHER": 1})
    assert [(x["contig"], x["pos"]) for x in r["samples"]] == [("2", 9), ("10", 0), ("10", 1), ("10", 2), ("10", 3)]


def test_attributes(spark):
    h = spark.createDataFrame([("a", "k", "1"), ("b", "k", "1"), ("a", "m", "1"), ("a", "n", "1"), ("b", "n", "2")], "file string, key string, value string")
    got = {r["key"]: (r["files"], r["verdict"], r["by_value"]) for r in summary.attribute_agreement(h, 2).collect()}
    assert got == {"k": (2, "same", {"1": ["a", "b"]}), "m": (1, "partial", {"1": ["a"]}), "n": (2, "differs", {"1": ["a"], "2": ["b"]})}


def test_manifest(spark):
    d = lambda c: c * 32
    rows = lambda x: spark.createDataFrame(x, "digest string, name string")
    manifest = rows([(d("a"), "same"), (d("a"), "other"), (d("a"), "gone"), ("A" * 32, "upper"), (None, "none"), (d("a"), "unhashed")])
    listing = rows([(d("a"), "same"), (d("b"), "other"), ("A" * 32, "upper"), (None, "none"), (None, "unhashed"), (d("c"), "extra"), (d("c"), "README")])
    got = {r["name"]: r["status"] for r in audit.reconcile_manifest(manifest, listing, ["README"]).collect()}
    assert got == {"other": "differs", "gone": "missing", "upper": "malformed", "none": "malformed", "unhashed": "differs", "extra": "extra"}


def test_settings(spark):
    kinds = spark.createDataFrame([("merged", "flavour"), ("refseq", "flavour"), ("pick", "semantic"), ("cache", "ignored")], "flag string, kind string")
    settings = spark.createDataFrame([("a", "merged"), ("a", "pick"), ("b", "cache"), ("c", "merged"), ("c", "refseq"), ("d", "refseq"), ("d", "new")], "run string, flag string")
    declared = spark.createDataFrame([("a", "merged"), ("b", "ensembl"), ("c", "merged"), ("d", "merged"), ("e", "ensembl")], "run string, flavour string")
    got = {r["run"]: (r["resolved"], r["verdict"]) for r in audit.audit_flavours(settings, kinds, declared, "ensembl").collect()}
    assert got == {"a": ("merged", "ok"), "b": ("ensembl", "ok"), "c": (None, "both"), "d": ("refseq", "differs"), "e": ("ensembl", "ok")}
    with pytest.raises(ValueError, match="both.*differs.*unknown new"):
        audit.require_settings(settings, kinds, declared, "ensembl")
    audit.require_settings(settings.where("run in ('a', 'b')"), kinds, declared.where("run in ('a', 'b', 'e')"), "ensembl")


def test_order_over_partitions(spark):
    """Places, sums and the row before, over many range partitions and one group with nearly all rows."""
    before_ = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    rows = [("a" if i % 50 else "b", i, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(5)
    got = {(r["g"], r["i"]): r["s"] for r in order.running(df, ["g"], ["i"], "v", "s", Store(spark, "t")).collect()}
    sums = {"a": 0, "b": 0}
    for g, i, v in rows:
        sums[g] += v
        assert got[g, i] == sums[g]
    before = {r["i"]: r["p"] and r["p"]["i"] for r in order.with_previous(df, ["i"], ["i"], "p", Store(spark, "t")).collect()}
    assert before == {i: i - 1 if i else None for i in range(1000)}
    spark.conf.set("spark.sql.shuffle.partitions", before_)


def test_order_audit(spark):
    ranks = spark.createDataFrame([("1", 0), ("2", 1), ("10", 2)], "contig string, rank int")
    rows = lambda *x: spark.createDataFrame([("f", c, p, i) for i, (c, p) in enumerate(x)], "s string, c string, p long, q long")
    run = lambda df: audit.order_violations(df, "s", "c", "p", "q", ranks, Store(spark, "t"))
    assert run(rows(("chr1", 5), ("1", 5), ("1", 9), ("2", 1), ("10", 1))).count() == 0
    got = [tuple(r)[1:6] for r in run(rows(("1", 200), ("1", 100), ("10", 1), ("2", 1), ("1", 300), ("Q", 1))).orderBy("seq").collect()]
    assert got == [("position", "1", 100, "1", 200), ("contig", "2", 1, "10", 1), ("contig", "1", 300, "2", 1), ("unranked", "Q", 1, "1", 300)]
    with pytest.raises(ValueError, match="1:100 came after 1:200"):
        audit.require_sorted(run(rows(("1", 200), ("1", 100))))


def test_id_membership_forms_agree(spark):
    ids, table = spark.range(0, 40, 3), spark.createDataFrame([(i % 20, i) for i in range(60)], "tid long, x long")
    forms = [sorted(map(tuple, audit.id_membership(ids, table, ["nope", "tid"], literals).collect())) for literals in (1000, 0)]
    assert forms[0] == forms[1] == [(i, i < 20) for i in range(0, 40, 3)]
    with pytest.raises(ValueError, match="tid"):
        audit.id_membership(ids, table, ["nope"])


def test_summaries_go_through_json(spark, tmp_path):
    shards, fields = tables(spark, [shard("r", "1", 10, ot=2, to=["Y"]), shard("r_long", "1")], [field("r", "1", "S", 10, value_diff=2), field("r", "1", "T", 10), field("r_long", "1")])
    shards = shards.unionByName(tables(spark, [shard("stub", None, status="no_gt")], [field("x", "1")])[0])
    few = spark.createDataFrame([("r", "1", "S", 1, "1:5 A>T T|f", "x", "", "value_diff")], "run string, contig string, field string, place int, locus string, candidate_val string, truth_val string, category string")
    path = str(tmp_path / "summaries")
    records.write_summaries(shards, fields, few, path)
    s, f, e = records.read_summaries(spark, path)
    back = {(r["run"], r["contig"]): r for r in s.collect()}
    assert back["r", "1"]["only_truth"] == 2 and back["r", "1"]["truth_only_fields"] == ["Y"] and back["stub", None]["status"] == "no_gt"
    assert sorted(map(tuple, f.collect())) == sorted(map(tuple, fields.collect()))
    assert sorted(map(tuple, e.select(*few.columns).collect())) == sorted(map(tuple, few.collect()))
    merged = summary.merge_samples(e.select(*few.columns)).first()
    assert (merged["place"], merged["locus"]) == (1, "1:5 A>T T|f")
    line = next(r["value"] for r in spark.read.text(path).collect() if '"r"' in r["value"])
    for name, text, what in (("more", line.replace("{", '{"new_counter":1,', 1), "new_counter"), ("less", line.replace('"only_truth"', '"gone"'), "only_truth"), ("unnamed", line.replace('"name":"r"', '"name":null'), "no name")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError, match=what):
            records.read_summaries(spark, str(tmp_path / name))
    (tmp_path / "renamed").write_text(line.replace('"only_truth"', '"only_b"').replace(",", ",\n"))
    assert records.read_summaries(spark, str(tmp_path / "renamed"), whole_files=True, rename={"only_b": "only_truth"})[0].first()["only_truth"] == 2


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("r", f"chr{i % 3 + 1}", i) for i in range(300)] + [("r", "chr10", 1)], "run string, contig string, pos long")
    counts = {r["contig"]: r["n"] for r in records.write_by_contig(rows, str(tmp_path / "c")).collect()}
    assert counts == {"chr1": 100, "chr2": 100, "chr3": 100, "chr10": 1}
    with pytest.raises(ValueError, match="nothing"):
        records.write_by_contig(rows.limit(0), str(tmp_path / "none"))
    records.write_shards(rows, str(tmp_path / "s"))
    records.write_shards(rows.where("contig = 'chr2'").limit(5), str(tmp_path / "s"))
    got = {r["contig"]: r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("contig").count().collect()}
    assert got == {"chr1": 100, "chr2": 5, "chr3": 100, "chr10": 1}
    records.write_ordered(rows, str(tmp_path / "o"))
    files = sorted(p for p in (tmp_path / "o").glob("part-*"))
    order_ = [r["contig"] for p in files for r in spark.read.parquet(str(p)).collect()]
    assert order_ == sorted(order_, key=lambda c: int(c[3:]))
    parts = audit.union_checked({"a": rows, "b": rows.limit(3)})
    audit.require_union(audit.union_integrity(parts, spark.createDataFrame([("a", 301), ("b", 3)], "part string, expected long")))
    with pytest.raises(ValueError, match="b: 3 rows, not 4"):
        audit.require_union(audit.union_integrity(parts, spark.createDataFrame([("a", 301), ("b", 4)], "part string, expected long")))


def test_stream_takes_new_files_once(spark, tmp_path):
    from concord.streaming.resume import ingest_new

    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for n, expected in ((3, 3), (4, 7)):
        spark.range(n).withColumn("contig", F.lit("1")).write.mode("append").parquet(source)
        ingest_new(spark, source, "id long, contig string", target, check, by=("contig",))
        assert spark.read.parquet(target).count() == expected
    ingest_new(spark, source, "id long, contig string", target, check, by=("contig",))
    assert spark.read.parquet(target).count() == 7
