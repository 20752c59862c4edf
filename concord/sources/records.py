"""Reading and writing records, headers, tables and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from concord.functions.cells import CATEGORIES, natural_order, norm_contig, pct, rate
from concord.operators.unpack import extract

from .store import current, publish

_COUNTERS = ("aligned", "only_candidate", "only_truth", "malformed_candidate", "malformed_truth", "duplicate_candidate", "duplicate_truth")
#: Keys of a shard's summary and their types: identity, status, counters, what all shards share, what is collected, and
#: what follows from these.
SUMMARY = {
    **dict.fromkeys(("name", "cache", "status", "contig"), "string"),
    **dict.fromkeys(_COUNTERS, "bigint"),
    "shared_fields": "int",
    "candidate_only_fields": "array<string>",
    "truth_only_fields": "array<string>",
    "mismatches": "string",
    "overall_pct": "double",
    "join_rate": "double",
    "per_field": "map<string,struct<total:bigint,match:bigint,pct:double,by_category:map<string,bigint>>>",
    "samples": "map<string,array<array<string>>>",
}
#: What stands for a run without a truth side.
STUB = ("name", "cache", "status")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq, value): lines of text or gzip files; seq gives the order within a file. A gzip file is one split, so
    lines of gzip files are dealt out anew once they have their place."""
    lines = spark.read.text(path)
    seq = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    out = lines.select(F.col("_metadata.file_path").alias("file"), seq.alias("seq"), "value")
    return out.repartition(spark.sparkContext.defaultParallelism) if any(f.endswith(".gz") for f in lines.inputFiles()) else out


def _columns(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#")).withColumn("__c", F.split("value", "\t"))


def _at(i: int):
    return F.get("__c", F.lit(i))


def scan_records(lines: DataFrame, key: str = "CSQ") -> DataFrame:
    """(file, seq, contig, pos, ref, alt, packed, skipped): records of eight columns and more; skipped tells those
    without the key or with too few columns, which carry no annotation."""
    rows = _columns(lines).select("file", "seq", _at(0).alias("contig"), _at(1).try_cast("long").alias("pos"), _at(3).alias("ref"), _at(4).alias("alt"), extract(F.coalesce(_at(7), F.lit("")), key).alias("packed"), (F.size("__c") < 8).alias("short"))
    return rows.withColumn("skipped", F.col("short") | (F.col("packed") == "")).drop("short")


def scan_positions(lines: DataFrame) -> DataFrame:
    """(contig, pos) of each record, from its first two columns."""
    return _columns(lines).select(norm_contig(_at(0)).alias("contig"), _at(1).try_cast("long").alias("pos"))


def scan_keys(lines: DataFrame) -> DataFrame:
    """Distinct (contig, pos, ref, alt), alternatives as they stand."""
    return _columns(lines).select(norm_contig(_at(0)).alias("contig"), _at(1).try_cast("long").alias("pos"), _at(3).alias("ref"), _at(4).alias("alt")).distinct()


def require_positions(records: DataFrame) -> DataFrame:
    if not records.where("pos is null and not skipped").isEmpty():
        raise ValueError("a position is no integer")
    return records


def header_catalogue(lines: DataFrame) -> DataFrame:
    """(file, seq, key, value) of header lines."""
    return lines.where(F.col("value").startswith("##")).select("file", "seq", F.regexp_extract("value", r"^##([^=]+)=", 1).alias("key"), F.regexp_extract("value", r"^##[^=]+=(.*)$", 1).alias("value"))


def field_lists(header: DataFrame, key: str = "CSQ") -> DataFrame:
    """(file, fields) as each file's header declares them, the first declaration of each file."""
    rows = header.where(F.col("value").startswith(f"<ID={key},"))
    return rows.groupBy("file").agg(F.split(F.regexp_extract(F.min_by("value", "seq"), r'Format: ([^">]+)', 1), "[|]").alias("fields"))


def field_list(header: DataFrame, key: str = "CSQ") -> list[str]:
    """The packed fields that one side's files declare; a schema, so it comes to the driver. Files that disagree are an
    error, as are two sides given at once."""
    found = [r["fields"] for r in field_lists(header, key).select("fields").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"files declare different fields: {found}")
    return [f for f in found[0] if f] if found else []


def header_value(header: DataFrame, key: str) -> DataFrame:
    """(file, value) of a free header line, the first of each file."""
    return header.where(F.col("key") == key).groupBy("file").agg(F.min_by("value", "seq").alias("value"))


def contig_ranks(header: DataFrame) -> DataFrame:
    """(file, contig, rank) in order of declaration. A contig declared again takes the number of contigs declared up to
    then as its rank, which the next new one has too."""
    rows = header.where("key = 'contig'").select("file", norm_contig(F.regexp_extract("value", r"ID=([^,>]+)", 1)).alias("contig"), "seq")
    again = F.row_number().over(Window.partitionBy("file", "contig").orderBy("seq"))
    rows = rows.withColumn("new", F.when(again == 1, 1).otherwise(0))
    before = F.coalesce(F.sum("new").over(Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("before", before).groupBy("file", "contig").agg(F.max_by("before", "seq").cast("int").alias("rank"))


def header_attributes(header: DataFrame) -> DataFrame:
    """(file, key, value) of k="v" pairs in header lines."""
    pairs = F.expr(r"""regexp_extract_all(value, '([\\w.\\-]+="[^"]*")', 1)""")
    one = header.select("file", F.explode(pairs).alias("p"))
    return one.select("file", F.regexp_extract("p", r"^([^=]+)=", 1).alias("key"), F.regexp_extract("p", r'="([^"]*)"', 1).alias("value"))


def write_shards(df: DataFrame, path: str, by: tuple[str, ...] = ("run", "contig")) -> None:
    """Replaces the shards that df has and leaves all others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


#: How delimited mismatches are written and read: a quote within a quoted cell is doubled; nothing else is special.
_DELIMITED = {"sep": "\t", "header": True, "quote": '"', "escape": '"'}


def read_mismatches(spark: SparkSession, path: str) -> DataFrame:
    """A table of mismatches, whatever its line ends; empty cells are empty texts. Cells with quotes, tabs or line ends are
    quoted."""
    df = spark.read.csv(path, multiLine=True, **_DELIMITED)
    return df.select([F.rtrim(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit("\r")).alias(c.rstrip("\r")) for c in df.columns])


def write_mismatches(df: DataFrame, path: str, text: bool = False) -> None:
    """As text: cells that need it are quoted, so that read_mismatches() gives back what was written (null as empty)."""
    if text:
        df.write.mode("overwrite").csv(path, emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_DELIMITED)
    else:
        write_shards(df, path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A delimited table with a header; its columns must be there and it must have rows."""
    df = spark.read.csv(path, sep="\t", header=True)
    want = [c.split()[0] for c in schema.split(",")]
    if lacking := [c for c in want if c not in df.columns]:
        raise ValueError(f"{path} lacks {lacking}")
    if df.isEmpty():
        raise ValueError(f"{path} is empty")
    kinds = {c.split()[0]: c.split()[1] for c in schema.split(",")}
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in want])


def parse_regions(df: DataFrame, spec: str = "region") -> DataFrame:
    pattern = r"^([^:]+):(\d+)-(\d+)$"
    part = lambda i: F.regexp_extract(spec, pattern, i)
    return df.withColumns({"contig": part(1), "start": part(2).try_cast("long"), "end": part(3).try_cast("long")})


def write_summaries(shards: DataFrame, shard_fields: DataFrame, samples: DataFrame, path: str) -> None:
    """A JSON line for each shard (run, contig): its counters, fields by name with counts by category, samples by field.
    Shards that aren't ok are stubs of three keys."""
    cats = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, CATEGORIES)), F.array(*map(F.col, CATEGORIES))), lambda _, n: n > 0)
    stats = F.struct("total", "match", pct(F.col("match"), F.col("total")).alias("pct"), cats.alias("by_category"))
    fields = shard_fields.groupBy("run", "contig").agg(F.map_from_entries(F.collect_list(F.struct("field", stats))).alias("per_field"), pct(F.sum("match"), F.sum("total")).alias("overall_pct"))
    one = F.struct("place", F.array("locus", "candidate_val", "truth_val", "category").alias("s"))
    few = samples.groupBy("run", "contig", "field").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("s")).groupBy("run", "contig").agg(F.map_from_entries(F.collect_list(F.struct("field", "s"))).alias("samples"))
    rows = shards.drop("join_rate", "overall_pct").join(fields, ["run", "contig"], "left").join(few, ["run", "contig"], "left")
    rows = rows.withColumn("join_rate", rate(F.col("aligned"), F.col("aligned") + F.col("only_candidate") + F.col("only_truth")))
    empty = F.create_map().cast("map<string,array<array<string>>>")
    rows = rows.withColumns({"name": F.col("run"), "samples": F.coalesce("samples", empty)})
    whole, stub = F.to_json(F.struct(*list(SUMMARY)), {"ignoreNullFields": "false"}), F.to_json(F.struct(*STUB))
    rows.select(F.when(F.col("status") == "ok", whole).otherwise(stub).alias("value")).write.mode("overwrite").text(path)


def read_summaries(spark: SparkSession, path: str | list[str], whole_files: bool = False, rename: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(shards, shard_fields, samples) of JSON summaries, one to a line or one to a file, under the name that each declares.
    A summary has exactly the keys of SUMMARY, or those of STUB if its status isn't ok; anything else and a missing name are errors.
    rename maps other names of keys to ours."""
    raw = spark.read.text(path, wholetext=whole_files).where(F.trim("value") != "")
    keys = F.array_sort(F.transform(F.json_object_keys("value"), lambda k: _renamed(k, rename)))
    wanted = lambda names: F.array(*map(F.lit, sorted(names)))
    status = F.get_json_object("value", "$.status")
    good = keys.eqNullSafe(wanted(SUMMARY)) | ((status != "ok") & keys.eqNullSafe(wanted(STUB)))
    bad = raw.where(~F.coalesce(good, F.lit(False))).select(F.concat_ws(",", F.array_except(keys, wanted(SUMMARY))).alias("unknown"), F.concat_ws(",", F.array_except(wanted(SUMMARY), keys)).alias("missing")).limit(5).collect()
    if bad:
        raise ValueError("summaries with other keys than declared: " + "; ".join(f"unknown {r['unknown']}, missing {r['missing']}" for r in bad))
    back = {v: k for k, v in (rename or {}).items()}
    schema = ", ".join(f"`{back.get(c, c)}` {kind}" for c, kind in SUMMARY.items())
    out = raw.select(F.from_json("value", schema).alias("s")).select(*[F.col(f"s.`{back.get(c, c)}`").alias(c) for c in SUMMARY])
    if not out.where("name is null or name = ''").isEmpty():
        raise ValueError("a summary has no name")
    shards = out.withColumnRenamed("name", "run").drop("per_field", "samples", "overall_pct", "join_rate")
    entry = out.select(F.col("name").alias("run"), "contig", F.explode("per_field").alias("field", "s"))
    fields = entry.select("run", "contig", "field", "s.total", "s.match", *[F.coalesce(F.col("s.by_category")[c], F.lit(0)).alias(c) for c in CATEGORIES])
    few = out.select(F.col("name").alias("run"), "contig", F.explode("samples").alias("field", "s")).select("run", "contig", "field", F.posexplode("s").alias("place", "s"))
    at = lambda i: F.get("s", F.lit(i))
    return shards, fields, few.select("run", "contig", "field", (F.col("place") + 1).alias("place"), at(0).alias("locus"), at(1).alias("candidate_val"), at(2).alias("truth_val"), at(3).alias("category"))


def _renamed(key, rename: dict[str, str] | None):
    for old, new in (rename or {}).items():
        key = F.when(key == old, new).otherwise(key)
    return key


def write_by_contig(df: DataFrame, path: str, order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """A folder per contig in a new version of the table at path (see publish), written in ranges of contig and order, so
    that a long contig is many tasks and files and a file holds few positions. A total of nothing is refused before
    anything is published. Returns counts from what was written."""
    rows = df.repartitionByRange("contig", *order).sortWithinPartitions("contig", *order)
    if df.isEmpty():
        raise ValueError("nothing to write")
    publish(rows, path, ("contig",))
    return by_contig(df.sparkSession, path).groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


def by_contig(spark: SparkSession, path: str) -> DataFrame:
    """What write_by_contig() has published; contig is the partition, a text. A filter by contig reads its folder only, one
    by the order columns the row groups that can hold them."""
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    inferred = spark.read.parquet(found).schema
    schema = StructType([f if f.name != "contig" else StructField("contig", StringType()) for f in inferred])
    return spark.read.schema(schema).parquet(found)


def observed_outputs(spark: SparkSession, path: str | list[str], key: str) -> DataFrame:
    """(key, length) of files under path whose key is the first group of the pattern. Names and lengths only are read, no
    content; empty files are no outputs."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select(F.regexp_extract("path", key, 1).alias("key"), "length").where("key <> ''")


def read_settings(cells: DataFrame, run: str = "run", cell: str = "settings") -> DataFrame:
    """(run, flag, value) of settings given as a JSON object in a cell, a row for each key, values as text. An empty cell
    and one that is no JSON object are refused: a run of unknown settings must not be taken for one of default settings."""
    text = F.trim(F.coalesce(F.col(cell), F.lit("")))
    object_ = F.try_parse_json(text)
    fault = F.when(text == "", "empty").when(object_.isNull() | ~F.schema_of_variant(object_).startswith("OBJECT<"), "malformed")
    bad = cells.select(F.col(run).alias("run"), fault.alias("fault")).where("fault is not null").orderBy("run").limit(5).collect()
    if bad:
        raise ValueError("settings: " + "; ".join(f"{r['run']} has an {r['fault']} cell" if r["fault"] == "empty" else f"{r['run']} has a malformed cell" for r in bad))
    entries = F.from_json(text, "map<string,string>")
    return cells.select(F.col(run).alias("run"), F.explode(entries).alias("flag", "value"))


def write_ordered(df: DataFrame, path: str, then: tuple[str, ...] = ("pos",)) -> None:
    """Files in natural order of contigs and then of the columns given, for readers that go by files."""
    keys = natural_order(norm_contig(F.col("contig")))
    df.repartitionByRange(*keys, *then).sortWithinPartitions(*keys, *then).write.mode("overwrite").parquet(path)
