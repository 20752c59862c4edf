"""Packed annotations to rows: entries by comma, fields by bar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.cells import alt_key, norm_contig

RECORD = ["run", "contig", "pos", "ref", "alts"]


def extract(info: Column, name: str) -> Column:
    """Value of a key of a ;-separated string, empty where it is absent or empty."""
    return F.regexp_extract(info, rf"(?:^|;){name}=([^;\t]+)", 1)


def keyed(records: DataFrame) -> DataFrame:
    """Records (run, contig, pos, ref, alt, packed, seq) with normalised contigs and order-free alternatives."""
    return records.where(F.coalesce("packed", F.lit("")) != "").withColumns({"contig": norm_contig(F.col("contig")), "alts": alt_key(F.col("alt"))})


def repeated_keys(records: DataFrame) -> DataFrame:
    """(RECORD, __first, n) of record keys that occur more than once: a minimum and a count, summed in each task before
    they are shuffled. The records themselves stay where they are."""
    if "seq" not in records.columns:
        raise ValueError("first-wins needs a sequence column")
    return records.groupBy(*RECORD).agg(F.min("seq").alias("__first"), F.count(F.lit(1)).alias("n")).where("n > 1")


def with_later(records: DataFrame) -> DataFrame:
    """records with later_record: whether another record of the same key comes before, by seq (which must be unique within
    a key). Only keys that are repeated meet the records again; few of them are broadcast by the optimizer, and a key with
    many records is no group of its own."""
    again = repeated_keys(records).select(*[F.col(c).alias(f"__{c}") for c in RECORD], "__first")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in RECORD]
    later = F.coalesce(F.col("seq") > F.col("__first"), F.lit(False))
    return records.join(again, same, "left").withColumn("later_record", later).drop("__first", *[f"__{c}" for c in RECORD])


def first_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that stay, those after the first of their key). seq gives the order and must be there."""
    marked = with_later(records)
    return marked.where("not later_record").drop("later_record"), marked.where("later_record").drop("later_record")


def parts(n_fields: int, key: tuple[int, int] = (0, 1), packed: str = "packed") -> Column:
    """Entries of a packed text in order, as an array of structs: entry_no, allele, feature, values (the other fields, ''
    where missing), malformed (too short for the key)."""

    def part(entry: Column, no: Column) -> Column:
        fields = F.split(entry, r"\|")
        at = lambda f, i: F.coalesce(F.get(f, F.lit(i)), F.lit(""))
        made = lambda f: F.struct(no.alias("entry_no"), at(f, key[0]).alias("allele"), at(f, key[1]).alias("feature"), F.array(*[at(f, i) for i in range(n_fields) if i not in key]).alias("values"), (F.size(f) <= max(key)).alias("malformed"))
        return F.transform(F.array(fields), made)[0]

    return F.transform(F.split(packed, ","), part)


def marked_parts(n_fields: int, key: tuple[int, int] = (0, 1)) -> Column:
    """parts() with surplus: not the first well-formed entry of its key within the record. Entries are sorted by their key
    within the row, so that equal ones are neighbours; nothing is shuffled."""
    mark = lambda x: (x["malformed"], x["allele"], x["feature"])
    ordered = F.array_sort(F.transform(parts(n_fields, key), lambda x: F.struct(*[c.alias(n) for c, n in zip(mark(x), ("malformed", "allele", "feature"))], x["entry_no"].alias("entry_no"), x["values"].alias("values"))))

    def flagged(rows: Column) -> Column:
        same = lambda x, y: (x["allele"] == y["allele"]) & (x["feature"] == y["feature"]) & ~y["malformed"]
        return F.transform(rows, lambda x, i: x.withField("surplus", ~x["malformed"] & F.when(i > 0, same(x, F.get(rows, i - 1))).otherwise(False)))

    return F.transform(F.array(ordered), flagged)[0]


def unusable(n_fields: int, key: tuple[int, int] = (0, 1)) -> Column:
    """How many entries of a packed text are malformed or surplus."""
    if key == (0, 1):
        found = F.split("packed", ",")
        return F.size(found) - F.size(F.array_distinct(F.transform(F.filter(found, lambda e: F.contains(e, F.lit("|"))), lambda e: F.substring_index(e, "|", 2))))
    return F.size(F.filter(marked_parts(n_fields, key), lambda x: x["malformed"] | x["surplus"]))


#: Record keys in the order in which they are sorted: a position tells most of them apart.
_SORTED = ["pos", "contig", "run", "ref", "alts"]


def first_wins(records: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """(RECORD, first: seq, alt and packed of the first record by seq, n: records of the key, bad: their unusable entries).
    One shuffle of packed records; records of one key are put together in each task before it, so a key with many is no
    group of its own. The result is dealt and sorted by the key, as a join of two sides needs them."""
    rows = keyed(records).select(*RECORD, F.struct("seq", "alt", "packed").alias("first"), unusable(n_fields, key).alias("bad"))
    return rows.groupBy(*_SORTED).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))


def first_annotations(records: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """annotations() of unpacked(), whose records meet once only: (RECORD, alt, allele, feature, values)."""
    rows = first_wins(records, n_fields, key).select(*RECORD, "first.alt", "first.packed")
    kept = F.filter(marked_parts(n_fields, key), lambda x: ~x["malformed"] & ~x["surplus"])
    rows = rows.select(*RECORD, "alt", F.explode(kept).alias("__e"))
    return rows.select(*RECORD, "alt", *[F.col(f"__e.{c}") for c in ("allele", "feature", "values")])


def entries(records: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """A row per entry: entry_no, allele, feature, values, malformed."""
    rows = records.select("*", F.explode(parts(n_fields, key)).alias("__e"))
    return rows.select(*records.columns, *[F.col(f"__e.{c}") for c in ("entry_no", "allele", "feature", "values", "malformed")]).drop("packed")


def unpacked(records: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """entries() of all records with what keeps an entry out of the join: later_record (not the first record of its key),
    malformed, surplus (not the first entry of its key within the record). No window, and no shuffle of records."""
    rows = with_later(keyed(records)).withColumn("__e", F.explode(marked_parts(n_fields, key)))
    keep = [c for c in rows.columns if c not in ("packed", "__e")]
    return rows.select(*keep, *[F.col(f"__e.{c}") for c in ("entry_no", "allele", "feature", "values", "malformed", "surplus")])


def side_counts(rows: DataFrame, side: str, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """(by, malformed_<side>, duplicate_<side>) of unpacked(): entries without a usable key or after the first of their key,
    over all records, and records after the first of theirs."""
    return rows.groupBy(*by).agg(F.count_if(F.col("malformed") | F.col("surplus")).alias(f"malformed_{side}"), F.count_if(F.col("later_record") & (F.col("entry_no") == 0)).alias(f"duplicate_{side}"))


def malformed_counts(rows: DataFrame) -> DataFrame:
    """(run, malformed) of unpacked(), for runs that have any."""
    return side_counts(rows, "side").where("malformed_side > 0").select("run", F.col("malformed_side").alias("malformed"))


def bad_counts(records: DataFrame, n_fields: int, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """malformed_counts() of records: counted within each, none is shuffled."""
    rows = keyed(records).groupBy("run").agg(F.sum(unusable(n_fields, key)).alias("malformed"))
    return rows.where("malformed > 0")


def lookup(records: DataFrame, allele: str, feature: str, n_fields: int, at: DataFrame | None = None, key: tuple[int, int] = (0, 1)) -> DataFrame:
    """(record's columns, values): the entry of one allele and feature in each record that has it, the first if there are
    several, picked inside the packed text before any row is made. at: (contig, pos) to look at, sent ahead as a filter."""
    rows = keyed(records)
    if at is not None:
        places = at.select(norm_contig(F.col("contig")).alias("contig"), "pos").distinct()
        rows = rows.join(places, ["contig", "pos"], "left_semi")
    starts = F.filter(F.split("packed", ","), lambda e: (F.get(F.split(e, r"\|"), F.lit(key[0])) == allele) & (F.get(F.split(e, r"\|"), F.lit(key[1])) == feature))
    rows = rows.withColumn("__e", F.get(starts, F.lit(0))).where("__e is not null").withColumn("__p", F.split("__e", r"\|"))
    values = F.array(*[F.coalesce(F.get("__p", F.lit(i)), F.lit("")) for i in range(n_fields) if i not in key])
    return rows.withColumn("values", values).drop("packed", "__e", "__p")


def annotations(rows: DataFrame) -> DataFrame:
    """What is joined: well-formed first entries of first records."""
    return rows.where("not later_record and not malformed and not surplus").drop("later_record", "malformed", "surplus", "entry_no", "seq")


def named_value(fields: list[str], name: str, column: str = "values") -> Column:
    """One packed field by its name in the header; a name that the header lacks is an error."""
    if name not in fields:
        raise ValueError(f"no field {name} in {fields}")
    return F.coalesce(F.get(column, F.lit(fields.index(name))), F.lit(""))


def split_multi(df: DataFrame, alt: str = "alt") -> DataFrame:
    """A row per alternative."""
    return df.withColumn(alt, F.explode(F.split(alt, ",")))


def field_asymmetry(candidate: list[str], truth: list[str]) -> tuple[list[str], list[str], list[str]]:
    """(shared fields in the candidate's order, candidate-only sorted, truth-only sorted) of two headers' field lists."""
    return [f for f in candidate if f in truth], sorted(set(candidate) - set(truth)), sorted(set(truth) - set(candidate))


def run_asymmetry(candidate: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """(run, shared_fields, candidate_only_fields, truth_only_fields) of field lists (run, fields) as headers declare them:
    how many fields both sides of a run have, and those of one side only, sorted. keys: fields that make the key."""
    a, b = (df.select("run", F.array_except("fields", F.array(*map(F.lit, keys))).alias(x)) for df, x in ((candidate, "a"), (truth, "b")))
    held = lambda x: F.coalesce(F.col(x), F.array().cast("array<string>"))
    only = lambda x, y: F.array_sort(F.array_except(held(x), held(y)))
    return a.join(b, "run", "full_outer").select("run", F.size(F.array_intersect(held("a"), held("b"))).alias("shared_fields"), only("a", "b").alias("candidate_only_fields"), only("b", "a").alias("truth_only_fields"))


def compare_fields(candidate: DataFrame, truth: DataFrame) -> DataFrame:
    """(part, field): the same for fields given as rows (field, repeats allowed)."""
    a, b = (df.select("field").distinct().withColumn(name, F.lit(True)) for df, name in ((candidate, "a"), (truth, "b")))
    part = F.when(F.col("b").isNull(), "candidate_only").when(F.col("a").isNull(), "truth_only").otherwise("shared")
    return a.join(b, "field", "full_outer").select(part.alias("part"), "field")
