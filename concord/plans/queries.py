"""Queries over the given tables, one or more for each operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.functions import cells as C
from concord.operators import audit, diff, ranges, summary, unpack
from concord.sources import blocks, records
from concord.sources.store import Store, touch
from concord.streaming.resume import Incremental

from .arms import CACHES, FIELDS, FLAGS, KEYS, N_FIELDS, NEEDS, RUNS, arms, headers


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _cache():
    out = F.lit(None).cast("string")
    for run, value in CACHES.items():
        out = F.when(F.col("run") == run, value).otherwise(out)
    return out


class _Study:
    """The pieces of one reconciliation, made on demand. Queries that count both sides take everything from one tally of
    the join; those that read matched records more than once store them first."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf, self.store = spark, sf, Store(spark, "study")
        self.c, self.t = arms(spark, sf)
        self.matched = diff.match_records(self.c, self.t, N_FIELDS)
        self._tally = None

    @property
    def joined(self) -> DataFrame:
        return diff.align_matched(self.matched, N_FIELDS)

    def keep(self) -> _Study:
        if not hasattr(self.matched, "stored_at"):
            self.matched = self.store.put(self.matched)
        return self

    def mismatches(self, stored: bool = False) -> DataFrame:
        out = diff.cell_mismatches(self.joined, FIELDS, FLAGS, NEEDS)
        return self.store.put(out) if stored else out

    def tally(self) -> DataFrame:
        if self._tally is None:
            self._tally = self.store.put(diff.tally(self.joined, FIELDS, FLAGS, NEEDS))
        return self._tally

    def field(self, by=("run",)) -> DataFrame:
        return diff.per_field(self.tally(), diff.tallied_coverage(self.tally(), by), FIELDS, by)

    def shards(self) -> DataFrame:
        by = ["run", "contig"]
        self.keep()
        out = diff.tallied_coverage(self.tally(), tuple(by)).join(diff.matched_counts(self.matched, tuple(by)), by, "left")
        found = headers(self.spark, self.sf)
        fields = unpack.run_asymmetry(*(found.where(F.col("side") == side) for side in ("candidate", "truth")), KEYS)
        status = F.when(F.col("aligned") + F.col("only_truth") > 0, "ok").otherwise("no_gt")
        out = out.fillna(0).withColumns({"status": status, "mismatches": F.concat_ws("/", *by), "cache": _cache()})
        return out.join(F.broadcast(fields), "run", "left")

    def merged(self) -> DataFrame:
        return summary.merge_shards(self.shards())


def build_arms(spark, sf):
    """How many records the arms have; the first query over a folder of tables makes and stores them."""
    c, t = arms(spark, sf)
    return c.groupBy("run").agg(F.count(F.lit(1)).alias("candidate")).join(t.groupBy("run").agg(F.count(F.lit(1)).alias("truth")), "run")


def scan_text(spark, sf):
    """The candidate arm written as lines of text, a folder for each run, and scanned."""
    path = Store(spark, "text").path()
    line = F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("."), F.concat(F.lit("N=1;CSQ="), "packed"))
    arms(spark, sf)[0].select("run", line.alias("value")).write.partitionBy("run").text(path)
    rows = records.require_positions(records.scan_records(records.read_lines(spark, path)))
    rows = rows.where("not skipped").withColumn("run", F.regexp_extract("file", "run=([^/]+)", 1))
    return rows.select("run", C.norm_contig(F.col("contig")).alias("contig"), "pos", "ref", "alt", "packed")


def scan_blocks(spark, sf):
    """The same from block-compressed files, a folder for each run, each file read by several tasks."""
    path = Store(spark, "blocks").path()
    line = F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("."), F.concat(F.lit("N=1;CSQ="), "packed"))
    for run in RUNS:
        own = arms(spark, sf)[0].where(F.col("run") == run)
        blocks.write_blocks(own.coalesce(max(2, own.rdd.getNumPartitions() // 4)).select(line.alias("value")), f"{path}/run={run}")
    rows = records.require_positions(records.scan_records(blocks.read_blocks(spark, path, split=1 << 18)))
    rows = rows.where("not skipped").withColumn("run", F.regexp_extract("file", "run=([^/]+)", 1))
    return rows.select("run", C.norm_contig(F.col("contig")).alias("contig"), "pos", "ref", "alt", "packed")


def _lines(spark, sf):
    """Records of the candidate arm as lines of text."""
    path = Store(spark, "text").path()
    c = arms(spark, sf)[0]
    c.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("."), F.concat(F.lit("CSQ="), "packed")).alias("value")).write.text(path)
    return records.read_lines(spark, path)


def scan_positions(spark, sf):
    return records.scan_positions(_lines(spark, sf))


def scan_keys(spark, sf):
    return records.scan_keys(_lines(spark, sf))


def annotated_records(spark, sf):
    """Records by contig, once the header of the files that they come from declares the annotation."""
    header = Store(spark, "header").path()
    declared = arms(spark, sf)[0].where("packed <> ''").limit(1).select(F.lit('##INFO=<ID=CSQ,Number=.,Description="Format: Allele|Feature">').alias("value"))
    declared.write.text(header)
    rows = records.scan_records(_lines(spark, sf)).where("not skipped")
    found = audit.assert_annotated(rows, records.header_catalogue(blocks.read_headers(spark, header)))
    return found.groupBy(C.norm_contig(F.col("contig")).alias("contig")).agg(F.count(F.lit(1)).alias("n"))


def dimension_table(spark, sf):
    """Suppliers as a delimited text with a header, read with types."""
    path = Store(spark, "dimension").path()
    _table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.csv(path, sep="\t", header=True)
    return records.read_table(spark, path, "s_suppkey bigint,s_name string,s_nationkey int")


def contig_ranks(spark, sf):
    """Ranks by the headers of files, one file for each run, written from the contigs that occur; a record and a line that
    only looks like a header stand after the header."""
    path = Store(spark, "headers").path()
    c = arms(spark, sf)[0].select("run", "contig").distinct()
    line = lambda k, value: F.struct(F.lit(k).alias("k"), value.alias("value"))
    lines = F.array(line(1, F.concat(F.lit("##contig=<ID="), "contig", F.lit(">"))), line(2, F.concat(F.lit("#CHROM\tPOS"), F.lit(""))), line(3, F.concat("contig", F.lit("\t1"))), line(4, F.concat(F.lit("##contig=<ID=late"), "contig", F.lit(">"))))
    rows = c.select("run", "contig", F.inline(lines))
    rows.repartition("run").sortWithinPartitions("run", "k", "contig").select("run", "value").write.partitionBy("run").text(path)
    ranks = records.contig_ranks(records.header_catalogue(blocks.read_headers(spark, path)))
    return ranks.select(F.regexp_extract("file", "run=([^/]+)", 1).alias("run"), "contig", "rank")


def mismatch_text(spark, sf):
    """The mismatches written as a delimited text and read again."""
    path = Store(spark, "mismatches").path()
    records.write_mismatches(_Study(spark, sf).mismatches().select("contig", "pos", "ref", "alt", "allele", "feature", "field", "candidate_val", "truth_val", "category"), path, text=True)
    return records.read_mismatches(spark, path).withColumn("pos", F.col("pos").cast("long"))


def mismatch_quotes(spark, sf):
    """The same with quotes, tabs, backslashes and line ends in the cells."""
    path = Store(spark, "mismatches").path()
    rows = _Study(spark, sf).mismatches().select("contig", "pos", "ref", "alt", "allele", "feature", "field", "candidate_val", "truth_val")
    odd = {"candidate_val": F.concat(F.lit('"'), "candidate_val", F.lit('" \\'), "field", F.lit("\t")), "truth_val": F.concat("truth_val", F.lit('\n""'))}
    records.write_mismatches(rows.withColumns(odd), path, text=True)
    return records.read_mismatches(spark, path).withColumn("pos", F.col("pos").cast("long"))


def summary_text(spark, sf):
    """The shards written as JSON summaries with their samples, read again and merged."""
    s = _Study(spark, sf)
    path = Store(spark, "summaries").path()
    counted = s.store.put(s.shards())
    records.write_summaries(counted, s.field(("run", "contig")), diff.samples(s.mismatches()), path)
    shards, fields, _ = records.read_summaries(spark, path)
    runs, by_field = summary.merge_checked(shards, fields, counted.select("run", "contig"), _runs(spark))
    totals = by_field.groupBy("run").agg(F.sum("total").alias("total"), F.sum("match").alias("match"))
    return runs.join(totals, "run").select("run", *summary.SUMS, "contigs", "join_rate", "total", "match")


def _runs(spark):
    return spark.sql("select explode(array(" + ", ".join(f"'{r}'" for r in RUNS) + ")) as run")


def scan_packed(spark, sf):
    return unpack.keyed(arms(spark, sf)[0]).select("run", "contig", "pos", "ref", "alt", "packed", "seq")


def unpack_annotations(spark, sf):
    rows = unpack.unpacked(arms(spark, sf)[1], N_FIELDS)
    return rows.select("run", "contig", "pos", "seq", F.col("entry_no").cast("long").alias("entry_no"), "allele", "feature", F.array_join("values", "|").alias("vals"), "malformed")


def malformed_counts(spark, sf):
    return unpack.bad_counts(arms(spark, sf)[1], N_FIELDS)


def duplicate_records(spark, sf):
    return unpack.first_records(unpack.keyed(arms(spark, sf)[1]))[1].groupBy("run").agg(F.count(F.lit(1)).alias("surplus"))


def alt_order_join(spark, sf):
    c, t = arms(spark, sf)
    rows = diff.match_records(c, t, N_FIELDS).where("l_n > 0 and r_n > 0").select("run", F.col("l_alt").alias("candidate_alt"), F.col("r_alt").alias("truth_alt"))
    return rows.groupBy("run").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("candidate_alt") != F.col("truth_alt")).alias("reordered"))


def split_multiallelic(spark, sf):
    return unpack.split_multi(arms(spark, sf)[0].select("run", "contig", "pos", "ref", "alt", "seq"))


def split_count_gate(spark, sf):
    return audit.split_count_gate(arms(spark, sf)[0])


def annotation_full_outer(spark, sf):
    return _Study(spark, sf).joined.select("run", "contig", "pos", "ref", "allele", "feature", "state")


def bucketed_runs(spark, sf):
    """Each run of the candidate against one bucketed table of the truth."""
    c, t = arms(spark, sf)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    truth = diff.store_bucketed(unpack.first_annotations(t, N_FIELDS), f"truth_{uuid.uuid4().hex}", n, Store(spark, "truth").path())
    candidate = unpack.first_annotations(c, N_FIELDS)
    runs = [diff.coverage_counts(diff.align(candidate.where(F.col("run") == run), truth.where(F.col("run") == run))) for run in RUNS]
    return runs[0].union(runs[1]).union(runs[2])


def incremental_fields(spark, sf):
    """The candidate's shards land, two runs and then the third, which is taken a few files at a time, and are reconciled as
    they land; the last batch is run again."""
    store = Store(spark, "incremental")
    landing, target, check = store.path(), store.path(), store.path()
    c, t = arms(spark, sf)
    schema, late = c.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), F.col("run") == RUNS[-1]
    going = Incremental(t, target, N_FIELDS, FIELDS, FLAGS, NEEDS)
    c.where(~late).write.parquet(landing)
    going.run(landing, schema, check)
    c.where(late).repartition(6, "contig").write.mode("append").parquet(landing)
    going.run(landing, schema, check, files=5)
    going.again(landing, schema)
    found = store.put(going.tally(rest=True))
    return diff.per_field(found, diff.tallied_coverage(found), FIELDS)


def packed_lookup(spark, sf):
    """One feature's entry in the records at a third of the positions."""
    c = arms(spark, sf)[0]
    at = _table(spark, sf, "orders").where("o_orderkey % 3 = 0").select((F.col("o_orderkey") % 22 + 1).cast("string").alias("contig"), F.col("o_orderkey").alias("pos"))
    return unpack.lookup(c, "N", "", N_FIELDS, at).select("run", "contig", "pos", "seq", F.array_join("values", "|").alias("vals"))


def coverage_counts(spark, sf):
    return diff.coverage_counts(_Study(spark, sf).joined)


def join_rate(spark, sf):
    return diff.join_rate(coverage_counts(spark, sf)).select("run", "join_rate")


def cell_mismatches(spark, sf):
    return _Study(spark, sf).mismatches().drop("alts")


def drift_classify(spark, sf):
    return _Study(spark, sf).mismatches().groupBy("run", "field", "category").agg(F.count(F.lit(1)).alias("n"))


def sentinel_match(spark, sf):
    rows = _Study(spark, sf).joined.where("state = 'both'").select("run", F.get("l", F.lit(5)).alias("a"), F.get("r", F.lit(5)).alias("b"))
    return rows.where("a <> b").groupBy("run").agg(F.count_if(C.norm_empty(F.col("a")) == C.norm_empty(F.col("b"))).alias("same_by_sentinel"))


def numeric_tolerance(spark, sf):
    rows = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("a"), (F.col("l_quantity") + (F.col("l_linenumber") - 4) * 0.01).cast("decimal(12,2)").cast("string").alias("b"))
    x, y = C.numeric_or_null(F.col("a")), C.numeric_or_null(F.col("b"))
    return rows.groupBy("l_linenumber").agg(F.count_if(C.is_close(x, y)).alias("close"), F.count_if(~C.is_close(x, y)).alias("apart"))


def order_only_diff(spark, sf):
    rows = _table(spark, sf, "lineitem").select(F.concat_ws("&", "l_returnflag", "l_linestatus").alias("a"), F.concat_ws("&", "l_linestatus", F.when(F.col("l_partkey") % 3 == 0, "X").otherwise(F.col("l_returnflag"))).alias("b"))
    return rows.groupBy("a", "b").agg(F.count_if(C.order_only(F.col("a"), F.col("b"))).alias("order_only"))


def per_field_concordance(spark, sf):
    return _Study(spark, sf).field().select("*", C.pct(F.col("match"), F.col("total")).alias("pct"))


def overall_concordance(spark, sf):
    return diff.overall(_Study(spark, sf).field())


def mismatch_samples(spark, sf):
    return diff.samples(_Study(spark, sf).mismatches())


def merge_shards(spark, sf):
    out = summary.merge_shards(_Study(spark, sf).shards())
    return out.select("run", *summary.SUMS, "cache", "shared_fields", _joined("candidate_only_fields"), _joined("truth_only_fields"), "status", "contigs", F.array_join("mismatches", ",").alias("mismatches"), "join_rate")


def _joined(column):
    return F.array_join(column, ",").alias(column)


def merge_fields(spark, sf):
    return summary.merge_fields(_Study(spark, sf).field(("run", "contig")))


def shard_set_violations(spark, sf):
    """Shards and fields with a fault of every kind put in."""
    s = _Study(spark, sf)
    shards = s.store.put(s.shards())
    at = lambda run, contig: (F.col("run") == run) & (F.col("contig") == contig)
    marked = shards.withColumn("status", F.when(at("m", "3"), "failed").otherwise("ok")).where(~at("clean", "5"))
    marked = marked.withColumn("cache", F.when(at("m", "4"), "other").otherwise(F.col("cache"))).withColumn("shared_fields", F.when(at("m_am", "8"), 5).otherwise(F.col("shared_fields")))
    marked = marked.unionByName(marked.where(at("m_am", "7")))
    fields = s.field(("run", "contig")).where(~(at("clean", "2") & (F.col("field") == "Note")))
    return summary.shard_violations(marked, shards.select("run", "contig").where(~at("m", "9")), fields)


def required_runs(spark, sf):
    shards = arms(spark, sf)[0].where("run <> 'clean'").select("run", "contig")
    return summary.required_runs(shards, _runs(spark).where("run <> 'm'"))


def run_status(spark, sf):
    shards = _Study(spark, sf).shards()
    return summary.run_status(shards.withColumn("status", F.when((F.col("run") == "m") | ((F.col("run") == "m_am") & (F.col("contig") == "3")), "no_gt").otherwise("ok")))


def true_concordance(spark, sf):
    return summary.true_concordance(_Study(spark, sf).field())


def coverage_verdict(spark, sf):
    return summary.coverage(_Study(spark, sf).merged()).select("run", "join_rate", "not_compared", "warnings", "n_warnings", "trustworthy")


def headline_risk(spark, sf):
    runs = _Study(spark, sf).merged()
    return summary.headline_risk(summary.coverage(runs.withColumn("status", F.when(F.col("run") == "m_am", "no_gt").otherwise(F.col("status")))))


def category_rollup(spark, sf):
    return summary.category_rollup(_Study(spark, sf).field())


def drift_rows(spark, sf):
    return summary.drift_rows(_Study(spark, sf).field()).withColumn("by_category", C.map_text(F.col("by_category")))


def worst_fields(spark, sf):
    s = _Study(spark, sf).keep()
    out = summary.worst_fields(summary.drift_rows(s.field()), diff.samples(s.mismatches()), 4, 2, 3)
    shown = F.array_join(F.transform("examples", lambda e: F.concat(e["locus"], F.lit(" "), e["category"])), ";")
    return out.select("run", "field", "real", "place", "dominant", shown.alias("examples"))


def triage_counts(spark, sf):
    return summary.triage_counts(_Study(spark, sf).mismatches())


def triage_rollup(spark, sf):
    out = summary.triage_rollup(_Study(spark, sf).mismatches(stored=True))
    rows = F.transform("samples", lambda x: F.concat_ws(":", x["run"], x["contig"], x["pos"].cast("string"), x["allele"], x["feature"], x["category"]))
    return out.select("field", "total", C.map_text(F.col("by_category")).alias("by_category"), C.map_text(F.col("by_kind")).alias("by_kind"), F.array_join(rows, ";").alias("samples"))


def prefix_kind_rollup(spark, sf):
    p = _table(spark, sf, "part")
    feature = F.element_at(F.array(*map(F.lit, ("", "ENSP", "NM_", "XR_", "Q"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = F.when(feature == "", "").otherwise(F.concat(feature, F.col("p_partkey").cast("string")))
    return p.groupBy(C.kind_of(name).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def slice_distinct_ids(spark, sf):
    return summary.slice_ids(_Study(spark, sf).mismatches(), "Price", "numeric_tol")


def fields_moved(spark, sf):
    return summary.fields_moved(_Study(spark, sf).field()).withColumn("by_category", C.map_text(F.col("by_category")))


def moved_totals(spark, sf):
    return summary.moved_totals(_Study(spark, sf).field())


def structure_violations(spark, sf):
    return summary.structure_violations(_Study(spark, sf).merged())


def moved_summary(spark, sf):
    """Over the runs that can be summed."""
    s = _Study(spark, sf)
    runs = s.merged()
    fit = runs.join(summary.structure_violations(runs), "run", "left_anti")
    return summary.moved_summary(s.store.put(fit), s.field())


def moved_matrix(spark, sf):
    return summary.field_matrix(_Study(spark, sf).field(), FIELDS, F.col("total") - F.col("match"))


def concordance_matrix(spark, sf):
    return summary.field_matrix(_Study(spark, sf).field(), FIELDS, C.pct(F.col("match"), F.col("total")))


def run_overview(spark, sf):
    s = _Study(spark, sf)
    return summary.overview(s.store.put(s.merged()), s.store.put(s.field()), RUNS)


def contig_counts(spark, sf):
    """Written by contig, counted from what was written."""
    return records.write_by_contig(unpack.keyed(arms(spark, sf)[0]), Store(spark, "contigs").path())


def _by_contig(spark, sf):
    """The candidate arm in a folder for each contig, in ranges of positions."""
    path = Store(spark, "contigs").path()
    records.write_by_contig(unpack.keyed(arms(spark, sf)[0]), path)
    return records.by_contig(spark, path)


def contig_filter(spark, sf):
    return ranges.filter_contig(_by_contig(spark, sf), "7").select("run", C.norm_contig(F.col("contig")).alias("contig"), "pos", "ref", "alt")


def region_slice(spark, sf):
    rows = ranges.slice_region(_by_contig(spark, sf), "chr7", 1000, 20000)
    return rows.select("run", F.concat(F.lit("chr"), "contig").alias("contig"), "pos")


def natural_order(spark, sf):
    rows = arms(spark, sf)[0].select(C.norm_contig(F.col("contig")).alias("contig")).distinct().union(spark.sql("select explode(array('X', 'MT')) as contig"))
    return rows.select("contig", F.row_number().over(Window.orderBy(*C.natural_order(F.col("contig")))).cast("long").alias("place"))


def field_asymmetry(spark, sf):
    """Two headers whose fields are the kinds of parts of two ranges of sizes."""
    part = _table(spark, sf, "part").withColumn("field", F.concat("p_brand", F.lit("_"), (F.col("p_partkey") % 40).cast("string")))
    return unpack.compare_fields(part.where("p_size < 30"), part.where("p_size > 20"))


def keyset_compare(spark, sf):
    c, t = arms(spark, sf)
    return audit.compare_keys(c, t, ["contig", "pos", "ref", "alt"])[0]


def keyset_only_left(spark, sf):
    c, t = arms(spark, sf)
    return audit.compare_keys(c, t, ["contig", "pos", "ref", "alt"])[1]


def keyset_examples(spark, sf):
    c, t = arms(spark, sf)
    return audit.examples(audit.compare_keys(c, t, ["contig", "pos", "ref", "alt"])[2], 10)


def unranked_contigs(spark, sf):
    ranks = _table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("contig")).where("contig < '3'")
    return audit.unranked_contigs(arms(spark, sf)[0], ranks)


def order_violations(spark, sf):
    """Events by type as files, months as contigs; one row of fifty stands 75 ids too late."""
    e = _table(spark, sf, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("contig"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("pos"), (F.when(F.col("event_id") % 50 == 0, F.col("event_id") + 75).otherwise(F.col("event_id")) * 1000000 + F.col("event_id")).alias("seq"))
    days = e.select("contig").distinct().where("contig not like '%-07'").withColumn("rank", F.row_number().over(Window.orderBy("contig")))
    return audit.order_violations(e, "event_type", "contig", "pos", "seq", days, Store(spark, "order"))


def positional_residual(spark, sf):
    o = _table(spark, sf, "orders")
    body = lambda mark, price: o.select(F.col("o_orderstatus").alias("contig"), F.col("o_orderkey").alias("seq"), F.concat(F.col("o_orderkey").cast("string"), mark, F.when(F.col("o_orderkey") % 50 == 0, price).otherwise("")).alias("line"))
    out = audit.positional_residual(body(F.when(F.col("o_orderkey") % 7 == 0, ";v=1").otherwise(""), F.lit(";a")), body(F.lit(""), F.lit(";b")), ";v=[0-9]+", Store(spark, "lines"))
    return out.withColumn("first", F.array_join(F.col("first").cast("array<string>"), ","))


def id_membership(spark, sf):
    ids = _table(spark, sf, "part").select((F.col("p_partkey") * 3).alias("id"))
    return audit.id_membership(ids, _table(spark, sf, "lineitem"), ["transcript", "l_partkey"])


def plan_vs_observed(spark, sf):
    plan = _table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 40 + 10).cast("double").alias("est"))
    li = _table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_linenumber") * 5).cast("double").alias("actual"))
    return audit.plan_vs_observed(plan, li.select("key"), li.where("n > 2").select("key", "actual"))


def plan_vs_observed_summary(spark, sf):
    return audit.plan_summary(plan_vs_observed(spark, sf))


def observed_outputs(spark, sf):
    """Shards by their files in storage: some were never written, some are empty, one in four took longer than planned."""
    path = Store(spark, "outputs").path()
    c = arms(spark, sf)[0].withColumn("contig", C.norm_contig(F.col("contig")))
    key = F.concat(F.lit("run="), "run", F.lit("/contig="), "contig")
    c.where("contig % 5 <> 0 and contig <> 1").select("run", "contig", "packed").write.partitionBy("run", "contig").text(path)
    for run in RUNS:
        touch(spark, f"{path}/run={run}/contig=1/part-0.txt")
    plan = c.select(key.alias("key"), F.col("contig").cast("double").alias("est")).distinct()
    timings = c.where("contig % 3 <> 0").groupBy("run", "contig").agg(F.max(F.col("contig").cast("int")).alias("x")).select(key.alias("key"), F.when(F.col("x") % 4 == 0, F.col("x") * 2).otherwise(F.col("x")).cast("double").alias("actual"))
    return audit.plan_vs_observed(plan, records.observed_outputs(spark, path, "(run=[^/]+/contig=[^/]+)/"), timings)


def planned_concat(spark, sf):
    """Shards put together as a plan lists them; orders' parts as chunks."""
    shards = _table(spark, sf, "orders").select((F.col("o_orderkey") % 22 + 1).cast("string").alias("contig"), (F.col("o_custkey") % 12).alias("chunk"), F.col("o_orderkey").alias("seq"))
    plan = shards.select("contig", "chunk").distinct().where("chunk <> 3").union(_table(spark, sf, "nation").where("n_nationkey < 2").select(F.lit("9").alias("contig"), (F.col("n_nationkey") + 100).alias("chunk")))
    rows, integrity = audit.concat_planned(plan, shards)
    got = rows.withColumn("part", F.spark_partition_id()).groupBy("contig", "chunk").agg(F.count(F.lit(1)).alias("rows"))
    return integrity.join(got, ["contig", "chunk"], "left").select("contig", "chunk", "n", "state", F.coalesce("rows", F.lit(0)).alias("rows"))


def settings_cells(spark, sf):
    """Settings of runs as JSON cells: how often each type of event occurs."""
    e = _table(spark, sf, "events").groupBy((F.col("user_id") % 30).cast("string").alias("run"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    cells = e.groupBy("run").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("event_type", "n")))).alias("settings"))
    return records.read_settings(cells)


def manifest_reconcile(spark, sf):
    c = _table(spark, sf, "customer")
    digest = lambda salt, m: F.when(F.col("c_custkey") % m == 0, F.lit("none")).otherwise(F.md5(F.concat("c_name", salt)))
    listing = lambda salt, m, cond: c.where(cond).select(digest(salt, m).alias("digest"), F.col("c_name").alias("name"))
    return audit.reconcile_manifest(listing(F.lit(""), 17, F.col("c_custkey") % 11 != 0), listing(F.when(F.col("c_custkey") % 13 == 0, "x").otherwise(""), 19, F.col("c_custkey") % 7 != 0))


def pairwise_runs(spark, sf):
    o = _table(spark, sf, "orders")
    part = lambda tag, m: o.select(F.lit(tag).alias("tag"), "o_orderkey", F.when(F.col("o_orderkey") % m == 0, "?").otherwise(F.col("o_orderpriority")).alias("v"))
    return audit.pairwise_runs(part("r1", 10**9).union(part("r2", 10)).union(part("r3", 15)), "tag", ["o_orderkey"], ["v"], ["r1", "r2", "r3"])


def _settings(spark, sf):
    """Settings of runs: the types of their events."""
    e = _table(spark, sf, "events").select(F.col("event_type").alias("flag"), (F.col("user_id") % 30).cast("string").alias("run"))
    e = e.where("(flag <> 'purchase' or run % 3 = 0) and (flag <> 'signup' or run % 4 = 0)").distinct()
    kinds = spark.sql("select * from values ('click', 'semantic'), ('view', 'ignored'), ('purchase', 'flavour'), ('signup', 'flavour') as kinds(flag, kind)")
    return e, kinds


def config_audit(spark, sf):
    return audit.audit_settings(*_settings(spark, sf))


def config_flavours(spark, sf):
    settings, kinds = _settings(spark, sf)
    declared = _table(spark, sf, "events").select((F.col("user_id") % 30).cast("string").alias("run")).distinct().withColumn("flavour", F.when(F.col("run") % 3 == 0, "purchase").when(F.col("run") % 5 == 0, "signup").otherwise("plain"))
    return audit.audit_flavours(settings, kinds, declared, "plain")


def integrity_counts(spark, sf):
    c, t = arms(spark, sf)
    plan = c.select("run", "contig").union(t.select("run", "contig")).distinct()
    return audit.integrity_counts(c, t, plan, ["run", "contig"])


def pending_shards(spark, sf):
    c, _ = arms(spark, sf)
    return audit.pending(c.select("run", "contig").distinct(), c.where("pos % 5 = 0 and run <> 'm'").select("run", "contig").distinct(), ["run", "contig"])


def union_integrity(spark, sf):
    c, t = arms(spark, sf)
    counts = c.agg(F.count(F.lit(1)).alias("expected")).select(F.lit("candidate").alias("part"), "expected").union(t.agg((F.count(F.lit(1)) + 1).alias("expected")).select(F.lit("truth").alias("part"), "expected"))
    return audit.union_integrity(audit.union_checked({"candidate": c, "truth": t}), counts)


def attribute_agreement(spark, sf):
    li = _table(spark, sf, "lineitem")
    headers = li.select((F.col("l_suppkey") % 4).alias("file"), F.concat(F.lit("k"), (F.col("l_partkey") % 9).cast("string")).alias("key"), F.when(F.col("l_partkey") % 9 < 3, F.col("l_returnflag")).otherwise("v").alias("value")).where("not (key = 'k5' and file = 2)")
    out = summary.attribute_agreement(headers, 4)
    by = F.transform(F.array_sort(F.map_entries("by_value")), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"].cast("array<string>"), ",")))
    return out.withColumn("by_value", F.array_join(by, ";"))


def _days(spark, sf):
    return _table(spark, sf, "orders").select(F.col("o_orderstatus").alias("contig"), (F.year("o_orderdate") * 400 + F.dayofyear("o_orderdate")).cast("long").alias("pos"))


def balanced_ranges(spark, sf):
    return ranges.balanced_ranges(_days(spark, sf), "contig", "pos", 9, Store(spark, "ranges"))


def independent_ranges(spark, sf):
    return ranges.balanced_ranges(_days(spark, sf), "contig", "pos", 9, Store(spark, "ranges"), mode="independent")


def range_input(spark, sf):
    """What keeps ranges from being cut: orders by status, one in a hundred standing 150 keys too late; letters of nations
    as the statuses wanted."""
    late = F.when(F.col("o_orderkey") % 100 == 0, F.col("o_orderkey") + 150).otherwise(F.col("o_orderkey"))
    rows = _table(spark, sf, "orders").select(F.col("o_orderstatus").alias("contig"), F.col("o_orderkey").alias("pos"), (late * 10_000_000_000 + F.col("o_orderkey")).alias("seq"))
    wanted = _table(spark, sf, "nation").select(F.substring("n_name", 1, 1).alias("contig"))
    return ranges.input_violations(rows, "contig", "pos", wanted, "seq", Store(spark, "sorted"))


def range_gaps(spark, sf):
    days = _days(spark, sf)
    regions = balanced_ranges(spark, sf).withColumn("start", F.when(F.col("chunk") % 4 == 0, F.col("start") + 1).otherwise(F.col("start")))
    regions = regions.withColumn("n", F.when((F.col("contig") == "P") & (F.col("chunk") == 2), F.col("n") + 1).otherwise(F.col("n")))
    return ranges.range_violations(regions, days.groupBy("contig").agg(F.count(F.lit(1)).alias("total")))


def assign_regions(spark, sf):
    got = ranges.assign_regions(_days(spark, sf), balanced_ranges(spark, sf))
    return got.groupBy("contig", "chunk").agg(F.count(F.lit(1)).alias("n"))


def expand_ranges(spark, sf):
    spec = _table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.concat((F.col("n_nationkey") + 1).cast("string"), F.lit("-"), (F.col("n_nationkey") + 4).cast("string"), F.lit(",X,"), F.col("n_nationkey").cast("string")).alias("spec"))
    return ranges.expand_ranges(spec)


def compress_ranges(spark, sf):
    items = _table(spark, sf, "lineitem").select((F.col("l_suppkey") % 10).alias("id"), F.when(F.col("l_linenumber") == 7, "X").otherwise((F.col("l_partkey") % 100).cast("string")).alias("item"))
    return ranges.compress_ranges(items)


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            scan_packed, scan_text, contig_ranks, unpack_annotations, malformed_counts, duplicate_records, alt_order_join, split_multiallelic, split_count_gate, annotation_full_outer, coverage_counts, join_rate,
            cell_mismatches, mismatch_text, drift_classify, sentinel_match, numeric_tolerance, order_only_diff, per_field_concordance, overall_concordance, mismatch_samples, merge_shards, merge_fields, summary_text,
            shard_set_violations, required_runs, run_status, true_concordance, coverage_verdict, headline_risk, category_rollup, drift_rows, worst_fields, triage_counts, triage_rollup, prefix_kind_rollup,
            slice_distinct_ids, fields_moved, moved_totals, structure_violations, moved_summary, moved_matrix, concordance_matrix, run_overview, contig_counts, contig_filter, region_slice, natural_order,
            field_asymmetry, keyset_compare, keyset_only_left, keyset_examples, unranked_contigs, order_violations, positional_residual, id_membership, plan_vs_observed, plan_vs_observed_summary,
            manifest_reconcile, pairwise_runs, config_audit, config_flavours, integrity_counts, pending_shards, union_integrity, attribute_agreement, balanced_ranges, independent_ranges, range_gaps,
            assign_regions, expand_ranges, compress_ranges, scan_blocks, scan_positions, scan_keys, annotated_records, dimension_table, mismatch_quotes, bucketed_runs, incremental_fields, packed_lookup,
            observed_outputs, planned_concat, settings_cells, build_arms, range_input,
        )
    }
