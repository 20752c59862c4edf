"""Order over whole tables without a task for a whole group: range partitions, sorted each, and offsets between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.sources.store import SMALL_ROWS, Store


def _carried(rows: DataFrame, edges: DataFrame, by: list[str], value: str) -> DataFrame:
    """rows with a column of edges (__p, by, value), a row for each partition and group at most; null groups are groups.
    Edges are sent to all tasks while they are few."""
    named = edges.select(*[F.col(c).alias(f"__e{c}") for c in ("__p", *by)], value)
    named = F.broadcast(named) if named.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else named
    same = [F.col(c).eqNullSafe(F.col(f"__e{c}")) for c in ("__p", *by)]
    return rows.join(named, same, "left").drop(*[f"__e{c}" for c in ("__p", *by)])



def placed(df: DataFrame, keys: list[str], store: Store) -> DataFrame:
    """df with __id, rising in the order of keys, and __p, the range partition of the row. Stored, so that both stay."""
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    return store.put(rows).withColumn("__p", F.shiftright("__id", 33))


def running(df: DataFrame, by: list[str], order: list[str], value: str, as_: str, store: Store) -> DataFrame:
    """df with as_: the sum of value within by up to and with the row. Sums run within a partition; what earlier
    partitions hold of a group is a row for each partition and group."""
    rows = placed(df, [*by, *order], store)
    rows = rows.withColumn(as_, F.sum(value).over(Window.partitionBy("__p", *by).orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)))
    sums = rows.groupBy("__p", *by).agg(F.sum(value).alias("__s"))
    before = F.coalesce(F.sum("__s").over(Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.withColumn("__before", before).drop("__s")
    return _carried(rows, offsets, by, "__before").withColumn(as_, F.col(as_) + F.col("__before")).drop("__p", "__id", "__before")


def numbered(df: DataFrame, by: list[str], order: list[str], as_: str, store: Store) -> DataFrame:
    """df with as_: the number of the row within by, from 1. Rows have their place from the range partition that they are
    written from; only the first place and the count of each group in a partition are summed up and sent back, so that no
    row is shuffled again and no group is a task."""
    rows = placed(df, [*by, *order], store)
    held = rows.groupBy("__p", *by).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = held.withColumn("__off", before - F.col("__first") + 1).drop("__first", "__n")
    return _carried(rows, offsets, by, "__off").withColumn(as_, F.col("__id") + F.col("__off")).drop("__p", "__id", "__off")


def next_value(df: DataFrame, by: list[str], order: list[str], value: str, as_: str, store: Store) -> DataFrame:
    """df with as_: the first value that isn't null in the row or after it, within by."""
    rows = placed(df, [*by, *order], store)
    back = Window.partitionBy("__p", *by).orderBy(F.desc("__id")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(as_, F.last(value, ignorenulls=True).over(back))
    firsts = rows.where(F.col(value).isNotNull()).groupBy("__p", *by).agg(F.min_by(value, "__id").alias("__v"))
    edges = rows.select("__p", *by).distinct()
    edges = edges.join(firsts.select(*[F.col(c).alias(f"__f{c}") for c in ("__p", *by)], "__v"), [F.col(c).eqNullSafe(F.col(f"__f{c}")) for c in ("__p", *by)], "left").drop(*[f"__f{c}" for c in ("__p", *by)])
    after = F.last("__v", ignorenulls=True).over(Window.partitionBy(*by).orderBy(F.desc("__p")).rowsBetween(Window.unboundedPreceding, -1))
    rows = _carried(rows, edges.withColumn("__after", after).drop("__v"), by, "__after")
    return rows.withColumn(as_, F.coalesce(as_, "__after")).drop("__p", "__id", "__after")


def with_previous(df: DataFrame, keys: list[str], what: list[str], as_: str, store: Store) -> DataFrame:
    """df with as_: a struct of the columns what of the row before in the order of keys, null for the first. The first row
    of a partition gets the last one of the partition before."""
    rows = placed(df, keys, store)
    struct = F.struct(*what)
    inside = F.lag(struct).over(Window.partitionBy("__p").orderBy("__id"))
    last = rows.groupBy("__p").agg(F.max_by(struct, "__id").alias("__last"))
    carried = last.select("__p", F.lag("__last").over(Window.orderBy("__p")).alias("__carried"))
    rows = rows.withColumn(as_, inside).join(F.broadcast(carried), "__p")
    return rows.withColumn(as_, F.coalesce(as_, "__carried")).drop("__p", "__id", "__carried")
