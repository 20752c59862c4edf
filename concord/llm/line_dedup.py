"""Operator 8: line deduplication by site-relative frequency.

Pages are grouped by host. A line's ratio is the number of the host's pages that contain it, over all its pages; lines
over the ratio are boilerplate and go from every page of that host.

Defined results: null text is empty; a null host is a host of its own; lines without a word are never boilerplate and
stay; a line counts once for each page however often it stands there; repeated rows count as pages; hosts with fewer
than min_pages pages containing a line lose nothing; extra columns pass through unless they are named like results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, free_name, text_of

#: Boilerplate lines broadcast at a time (8 bytes a line). A longer table is taken in parts by host, a pass over the
#: documents of these hosts for each.
BROADCAST_LINES = 500_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    return F.xxhash64(line)


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(docs: DataFrame, host: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, line): hashes of lines on more than ratio of a host's pages. Both counts are summed before the shuffle,
    so a host with a third of all pages is no larger there than another."""
    pages = docs.select(F.col(host).alias("host"), F.array_distinct(F.transform(F.filter(_lines(text_of()), _has_word), _key)).alias("lines"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("total"))
    often = counts.where(F.col("pages") >= min_pages)
    return often.join(totals, F.col("host").eqNullSafe(F.col("of"))).where(F.col("pages") > F.lit(ratio) * F.col("total")).select("host", "line")


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """All rows and columns of docs, text without boilerplate lines, and n_lines and n_dropped besides.

    A host has fewer than (lines of a page / ratio) boilerplate lines, so that a row per host holds them.
    """
    tables = Tables(docs.sparkSession, "lines")
    found = tables.put(boilerplate(docs, host, ratio, min_pages))
    at, bad, lines, kept = (free_name(docs, x) for x in ("host_", "bad_", "lines_", "kept_"))
    per_host = found.groupBy(F.col("host").alias(at)).agg(F.collect_set("line").alias(bad))
    total = found.count()
    n_parts = 1 if total <= BROADCAST_LINES else -(-2 * total // BROADCAST_LINES)
    part = lambda c: F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull()), F.lit(n_parts))
    passes = []
    for p in range(n_parts):
        mine = F.broadcast(per_host.where(part(at) == p))
        passes.append(docs.where(part(host) == p).join(mine, F.col(host).eqNullSafe(F.col(at)), "left"))
    rows = reduce(DataFrame.union, passes).withColumn(lines, _lines(text_of()))
    good = F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(bad, _key(x))))
    rows = rows.withColumn(kept, F.when(F.col(bad).isNull(), F.col(lines)).otherwise(good))
    n = F.size(lines).cast("long")
    return rows.withColumns({"text": F.array_join(kept, "\n"), "n_lines": n, "n_dropped": n - F.size(kept)}).drop(lines, at, bad, kept)
