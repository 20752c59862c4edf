"""Operator 9: mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id and text. The words of each source are summed by hash bucket, the bucket in
which the source's budget ends is refined by the next bits of the hash, and the documents below the threshold found are
taken. No sort of documents, and only one bucket of each source is read again. Rows with the hash at the threshold (one
document, or its repeats) are counted over range partitions, and as many as fit best are taken.

Defined results: null text has size 0; a null source is a source of its own, last in order; of rows with equal ids and
equal texts any may be the ones taken; rows that share an id only, null included, are told apart by their texts; an
empty table gives an empty result; other columns of the input don't matter.

What is kept for each source is one row; windows over sources run in one task, so sources must be fewer than a task can
sort (tens of millions of short rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.operators.order import running

from .common import Tables, free_name, words_of

#: Hash bits settled by each histogram, and how many histograms there are.
STEP, STEPS = 12, 5


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id and the text's MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit(""))))), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text.cast("string"), F.lit("")))).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """One row per source: (key, source_size, target). Sources in order of code points (null last) take the weights in
    turn and share the sum of all sizes; a target stops at cap times its source, and what is over goes to the others
    by weight. The windows run over sources, never over documents."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    per = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1).cast("long"))
    per = per.withColumn("ratio", F.lit(cap) * F.col("source_size") / F.col("weight"))
    per = (
        per.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left", F.col("total") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    open_ = F.col("left").cast(big) * F.col("weight") <= F.lit(cap) * F.col("source_size").cast(big) * F.col("weight_left")
    first = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("level", F.first(F.when(open_, F.struct("left", "weight_left")), ignorenulls=True).over(first))
    share = F.col("level.left").cast("double") * F.col("weight") / F.col("level.weight_left")
    return per.select("key", "source_size", F.when(F.col("level").isNull(), (F.lit(cap) * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame, tables: Tables) -> DataFrame:
    """(key, copies, edge, rows_at_edge): every document of a source is taken copies times, and once more if its hash is
    below edge, as are so many rows whose hash is edge."""
    s = F.col("source_size")
    copies = F.when(s > 0, F.floor(F.col("target") / s)).otherwise(F.lit(0)).cast("long")
    state = targets.select("key", copies.alias("copies"), (F.col("target") - copies * s).alias("need"))
    state, rows = state.withColumn("edge", F.lit(0).cast("long")), sized
    for step in range(1, STEPS + 1):
        shift = STEP * (STEPS - step)
        found = rows.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        found = found.withColumn("upto", F.sum("words").over(upto)).join(state, "key").where(F.col("upto") > F.col("need"))
        cut = found.groupBy("key", "copies").agg(F.min(F.struct("bucket", "words", "n", "upto", "need")).alias("b"))
        under = F.col("b.upto") - F.col("b.words")
        state = tables.put(cut.select("key", "copies", (F.col("b.need") - under).alias("need"), F.col("b.bucket").alias("edge"), F.col("b.words").alias("words"), F.col("b.n").alias("n")))
        if step < STEPS:
            inside = rows.join(state.select("key", "edge"), "key").where(F.shiftright("hash", shift) == F.col("edge")).select("key", "hash", "size")
            state, rows = state.drop("words", "n"), tables.put(inside)
    each = F.col("words") / F.col("n")
    return state.select("key", "copies", "edge", F.ceil(F.col("need") / each - 0.5).cast("long").alias("rows_at_edge"))


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), source.cast("string")))


def _sized(docs: DataFrame, id_col: str, tables: Tables) -> DataFrame:
    source = F.col("source").cast("string")
    return tables.put(docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), _key(source).alias("key"), word_count(F.col("text")).alias("size"), row_hash(F.col(id_col), F.col("text")).alias("hash")))


def source_cuts(sized: DataFrame, weights: tuple[int, ...], cap: int, tables: Tables) -> DataFrame:
    """One row per source: (key, source_size, target, edge, rows_at_edge), edge being null where no document is at the cut."""
    targets = tables.put(source_targets(sized, weights, cap))
    return tables.put(targets.join(thresholds(sized, targets, tables).drop("copies"), "key", "left"))


def with_copies(rows: DataFrame, hashed: str, cut: str, as_: str, tables: Tables) -> DataFrame:
    """rows with as_: how often each is taken. cut is a struct of source_cuts. Of rows at the edge some are taken: they are
    numbered over range partitions, as a source may be one document over and over; equal ones are told apart by where they
    stand in the table."""
    c = F.col(cut)
    base = F.when(c["source_size"] > 0, F.floor(c["target"] / c["source_size"])).otherwise(F.lit(0)).cast("long")
    at_edge = F.coalesce(F.col(hashed) == c["edge"], F.lit(False))
    below = F.coalesce(F.col(hashed) < c["edge"], F.lit(False))
    clear = rows.where(~at_edge).withColumn(as_, base + F.when(below, 1).otherwise(0))
    place, one, rank = (free_name(rows, x) for x in ("mix_place", "mix_one", "mix_rank"))
    edge = rows.where(at_edge).withColumns({place: F.monotonically_increasing_id(), one: F.lit(1).cast("long")})
    edge = running(edge, [hashed], [place], one, rank, tables)
    edge = edge.withColumn(as_, base + F.when(F.col(rank) <= c["rows_at_edge"], 1).otherwise(0)).drop(place, one, rank)
    return clear.unionByName(edge)


_CUT = ("source_size", "target", "edge", "rows_at_edge")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies): how often the mix takes each document, and its words."""
    tables = Tables(docs.sparkSession, "mixing")
    sized = _sized(docs, id_col, tables)
    cuts = source_cuts(sized, weights, cap, tables).select("key", F.struct(*_CUT).alias("cut"))
    out = with_copies(sized.join(cuts, "key"), "hash", "cut", "copies", tables)
    return out.select("doc_id", "source", "size", "cut.source_size", "cut.target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id") -> DataFrame:
    """Rows of docs that the mix takes, with mixed_size (words), mixed_target (words of the source) and copies (how often);
    columns of these names are replaced. Rows meet one row for each source, never each other, so texts aren't shuffled but
    for those at a source's edge."""
    tables = Tables(docs.sparkSession, "mixing")
    cuts = source_cuts(_sized(docs, id_col, tables), weights, cap, tables)
    rows = docs.drop("mixed_size", "mixed_target", "copies")
    key, cut, hashed = (free_name(rows, x) for x in ("mix_key", "mix_cut", "mix_hash"))
    cuts = cuts.select(F.col("key").alias(key), F.struct(*_CUT).alias(cut))
    out = rows.withColumns({key: _key(F.col("source")), hashed: row_hash(F.col(id_col), F.col("text"))}).join(cuts, key)
    out = with_copies(out, hashed, cut, "copies", tables).where("copies > 0")
    return out.withColumn("mixed_size", word_count(F.col("text"))).withColumn("mixed_target", F.col(cut)["target"]).drop(key, cut, hashed)
