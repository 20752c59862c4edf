"""Operator 11: hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers and are ordered along a Hilbert curve through all their dimensions, so that BLOCK neighbours are
alike; each block is a row of a Parquet table (folders of consecutive blocks) with the least and the greatest value of
each dimension, its zone map. By interval arithmetic the zone map bounds the scores that an anchor can have in a block.

Anchors are searched for in slices of at most ANCHORS, consecutive on the curve, whose vectors are sent to all tasks. A
search gives each request (an anchor, an interval of scores, labels equal or different, how many) its best rows in two
waves. The first reads the anchor's own block and those beside it; what it finds bounds the rest from below. The second
reads the folders with blocks whose bounds still meet a request, and in them scores only anchors that such a request has.
Within a task what has been found goes on raising the bounds. The first search finds positives, the second one negatives
in the window of each positive. Tasks give their best few rows of each request only.

Defined results: rows with a null label, a null vector, a null or non-finite component take no part, nor do those of a
component so large (over 2^28 / 256 for 64 dimensions) that a score could exceed 63 bits. Shorter vectors count as filled
up with zeros. Repeated rows and ids are rows of their own; "other" means another row, and among rows of one score and id
none is preferred. Rows with a null id are no anchors; as candidates they come after all others of the same score. An
empty table and an anchor without a positive or negative give no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Tables, small_batches

#: Rows of a block, anchors of a slice, bits of each dimension on the curve.
BLOCK, ANCHORS, BITS = 1024, 16_384, 4
#: Positives of an anchor, negatives of each, and their window as tenths of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 3, 9
SCALE = 256

_MIN, _MAX = -(2**63), 2**63 - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of cells (rows of coordinates below 2^bits), as bytes that sort like them. By the
    transform of Skilling (2004), all rows at once."""
    x = cells.T.astype(np.uint32)
    last = len(x) - 1
    for level in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(last + 1):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, last + 1):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[last] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    planes = np.concatenate([(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)])
    return [row.tobytes() for row in np.packbits(planes.T.astype(np.uint8), axis=1)]


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores that vectors can have with one between low and high."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ low + down @ high, up @ high + down @ low


class Requests(NamedTuple):
    """Anchors (vectors, labels, own blocks and places) and what is asked for: of which anchor, from and to which score,
    whether of its label, how many, and at least which score (0 or more have been found above it)."""

    vectors: np.ndarray
    labels: np.ndarray
    blocks: np.ndarray
    places: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int

    def open(self, block: int, zone_low: np.ndarray, zone_high: np.ndarray, label_low: int, label_high: int, near: bool, least: np.ndarray) -> np.ndarray:
        """Which requests a block can serve, in the wave for near blocks or in that for all others."""
        lower, upper = bounds(self.vectors, zone_low, zone_high)
        fits = (np.abs(self.blocks - block) <= 1) == near
        inside = (label_low <= self.labels) & (self.labels <= label_high)
        fits &= inside if self.same else ~(inside & (label_low == label_high))
        return np.flatnonzero(fits[self.of] & (upper[self.of] >= least) & (lower[self.of] <= self.high))


def _floats(column: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.int64).astype(kind) for x in column]


_FOUND = "req long, id long, known boolean, score long"
_BLOCK = "block long, ids binary, known binary, labels binary, vectors binary, low binary, high binary, label_low long, label_high long, part int"


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, ~known, -scores))[:k]
    return scores[order], ids[order], known[order]


def _search(sent, least, near: bool, kind):
    def run(batches):
        asked: Requests = sent.value
        floor = least.value.copy()
        best: dict[int, tuple[np.ndarray, ...]] = {}
        for batch in batches:
            lows, highs = _floats(batch.column("low"), kind), _floats(batch.column("high"), kind)
            for i in range(batch.num_rows):
                block, from_, to = (batch.column(c)[i].as_py() for c in ("block", "label_low", "label_high"))
                open_ = asked.open(block, lows[i], highs[i], from_, to, near, floor)
                if not len(open_):
                    continue
                ids, labels = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "labels"))
                known = np.frombuffer(batch.column("known")[i].as_py(), bool)
                vectors = np.frombuffer(batch.column("vectors")[i].as_py(), np.int64).reshape(len(ids), -1).astype(kind)
                anchors, row_of = np.unique(asked.of[open_], return_inverse=True)
                scores = (asked.vectors[anchors] @ vectors.T).astype(np.int64)
                right = (labels == asked.labels[anchors, None]) == asked.same
                own = np.flatnonzero(asked.blocks[anchors] == block)
                right[own, asked.places[anchors[own]]] = False
                for r, row in zip(open_.tolist(), row_of.tolist(), strict=True):
                    s = scores[row]
                    hit = np.flatnonzero(right[row] & (s >= floor[r]) & (s <= asked.high[r]))
                    if len(hit):
                        found = s[hit], ids[hit], known[hit]
                        if r in best:
                            found = tuple(map(np.concatenate, zip(best[r], found, strict=True)))
                        best[r] = found = _best(*found, asked.k)
                        if len(found[0]) == asked.k:
                            floor[r] = found[0][-1]
        n = [len(x[0]) for x in best.values()]
        columns = [np.concatenate([x[c] for x in best.values()]) if best else np.empty(0, np.int64) for c in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(best), np.int64), n), pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2].astype(bool), pa.bool_()), pa.array(columns[0], pa.int64())], ["req", "id", "known", "score"])

    return run


def _needed(sent, least, kind):
    """Folders of blocks that can serve a request in the second wave, by zone maps alone."""

    def run(batches):
        asked: Requests = sent.value
        for batch in batches:
            lows, highs = _floats(batch.column("low"), kind), _floats(batch.column("high"), kind)
            parts = batch.column("part").to_pylist()
            few = [batch.column(c).to_pylist() for c in ("block", "label_low", "label_high")]
            hit = {p for p, low, high, b, x, y in zip(parts, lows, highs, *few, strict=True) if len(asked.open(b, low, high, x, y, False, least.value))}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(hit), pa.int32())], ["part"])

    return run


class Blocks:
    """Candidates in blocks along the curve, and their zone maps."""

    def __init__(self, embeddings: DataFrame, tables: Tables):
        self.spark, self.tables = embeddings.sparkSession, tables
        kind = "array<double>"
        clean = embeddings.where("label is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(kind).alias("x"))
        clean = clean.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
        self.dims = clean.agg(F.max(F.size("x"))).first()[0]
        self.rows = clean.limit(0)
        if self.dims is None:
            return
        self.dims = max(1, self.dims)
        most = math.isqrt(_MAX // self.dims)
        clean = clean.withColumn("f", F.transform("x", lambda v: F.floor(v * SCALE).cast("double"))).where(~F.exists("f", lambda v: F.abs(v) > min(most, 2**53)))
        label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        filled = F.concat(F.transform("f", lambda v: v.cast("long")), F.array_repeat(F.lit(0).cast("long"), F.lit(self.dims) - F.size("f")))
        self.rows = clean.select("id", label.alias("label"), filled.alias("v"))

    def build(self) -> bool:
        """Writes blocks and zone maps; False if there are no rows."""
        if self.dims is None:
            return False
        n, least, most = self.rows.agg(F.count(F.lit(1)), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
        if not n:
            return False
        exact = self.dims * max(abs(least), abs(most)) ** 2 < 2**53
        self.kind = np.float64 if exact else np.int64
        keyed = self.rows.mapInArrow(_keys(least, most), "id long, label long, v array<long>, key binary")
        dealt = keyed.repartitionByRange(max(1, n // (8 * BLOCK)), "key", "id").sortWithinPartitions("key", "id").withColumn("part", F.spark_partition_id())
        packed = dealt.select("id", "label", "v", "part").mapInArrow(_pack, _BLOCK.replace("block long, ", ""))
        path = self.tables.path()
        packed.withColumn("block", F.monotonically_increasing_id()).write.option("compression", "zstd").partitionBy("part").parquet(path)
        self.blocks = self.spark.read.schema(_BLOCK).parquet(path)
        self.zones = self.tables.put(self.blocks.select("block", "low", "high", "label_low", "label_high", "part"))
        return True

    def anchors(self, every: int) -> DataFrame:
        """(id, label, vector, block, place, part) of rows whose id is divisible by every."""

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, labels = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "labels"))
                    known = np.frombuffer(batch.column("known")[i].as_py(), bool)
                    at = np.flatnonzero(known & (ids % every == 0))
                    width = len(batch.column("vectors")[i].as_py()) // len(ids)
                    vectors = np.frombuffer(batch.column("vectors")[i].as_py(), np.uint8).reshape(len(ids), width)
                    block, part = (np.full(len(at), batch.column(c)[i].as_py()) for c in ("block", "part"))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), pa.array([v.tobytes() for v in vectors[at]], pa.binary()), pa.array(block, pa.int64()), pa.array(at, pa.int64()), pa.array(part, pa.int32())], ["id", "label", "vector", "block", "place", "part"])

        return self.tables.put(self.blocks.select("block", "ids", "known", "labels", "vectors", "part").mapInArrow(run, "id long, label long, vector binary, block long, place long, part int"))

    def search(self, asked: Requests, parts: tuple[int, int]) -> DataFrame:
        """(req, id, known, score, rank): the best rows of each request. parts: first and last folder of the anchors."""
        context = self.spark.sparkContext
        sent, least = context.broadcast(asked), context.broadcast(asked.low)
        beside = self.blocks.where(F.col("part").between(parts[0], parts[1]))
        first = self.tables.put(beside.mapInArrow(_search(sent, least, True, self.kind), _FOUND))
        full = first.groupBy("req").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.col("n") >= asked.k).select("req", F.get("s", F.lit(asked.k - 1)).alias("score")).toArrow()
        floor = asked.low.copy()
        at = full["req"].to_numpy()
        floor[at] = np.maximum(floor[at], full["score"].to_numpy())
        least = context.broadcast(floor)
        needed = sorted(r["part"] for r in self.zones.mapInArrow(_needed(sent, least, self.kind), "part int").distinct().collect())
        second = self.blocks.where(F.col("part").isin(needed)).mapInArrow(_search(sent, least, False, self.kind), _FOUND) if needed else first.limit(0)
        order = Window.partitionBy("req").orderBy(F.desc("score"), F.desc("known"), "id")
        return self.tables.put(first.union(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= asked.k))


def _keys(least: int, most: int):
    def run(batches):
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            cells = np.minimum((flat - least) / (float(most) - least + 1) * (1 << BITS), (1 << BITS) - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, BITS) if batch.num_rows else [], pa.binary())], [*batch.schema.names, "key"])

    return run


def _pack(batches):
    """Blocks of consecutive rows with their zone maps."""
    held: list[pa.RecordBatch] = []
    n = 0

    def block(rows: pa.Table):
        ids = rows["id"].combine_chunks()
        known = ~np.asarray(ids.is_null())
        v = rows["v"].combine_chunks().flatten().to_numpy().reshape(len(known), -1)
        labels = rows["label"].to_numpy()
        binaries = [np.asarray(ids.fill_null(0), np.int64), known, labels, np.ascontiguousarray(v), v.min(0), v.max(0)]
        values = [pa.array([x.tobytes()], pa.binary()) for x in binaries]
        return pa.RecordBatch.from_arrays([*values, pa.array([labels.min()], pa.int64()), pa.array([labels.max()], pa.int64()), pa.array([rows["part"][0].as_py()], pa.int32())], ["ids", "known", "labels", "vectors", "low", "high", "label_low", "label_high", "part"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK:
            rows = pa.Table.from_batches(held)
            for i in range(0, n - n % BLOCK, BLOCK):
                yield block(rows.slice(i, BLOCK))
            held, n = rows.slice(n - n % BLOCK).to_batches(), n % BLOCK
    if n:
        yield block(pa.Table.from_batches(held))


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _slices(anchors: DataFrame) -> list[tuple[int, int]]:
    """Ranges of blocks with at most ANCHORS anchors each (or of one block), by counts of blocks."""
    out, n = [], ANCHORS + 1
    for r in anchors.groupBy("block").count().orderBy("block").toLocalIterator():
        if n + r["count"] > ANCHORS:
            out.append((r["block"], r["block"]))
            n = 0
        out[-1], n = (out[-1][0], r["block"]), n + r["count"]
    return out


def _id(known, at: str = "id"):
    return F.when(known, F.col(at))


def mine(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): of each anchor (id divisible by every)
    and each of its positives the best rows of other labels within the positive's window."""
    spark: SparkSession = embeddings.sparkSession
    small_batches(spark)
    tables = Tables(spark, "negatives")
    blocks = Blocks(embeddings, tables)
    out = spark.createDataFrame([], _RESULT)
    if not blocks.build():
        return out
    anchors = blocks.anchors(every)
    for first, last in _slices(anchors):
        got = anchors.where(F.col("block").between(first, last)).toArrow()
        vectors = np.stack([np.frombuffer(v.as_py(), np.int64) for v in got["vector"]]).astype(blocks.kind)
        each = np.arange(len(vectors))
        place = [got[c].to_numpy() for c in ("label", "block", "place")]
        parts = got["part"].to_numpy()
        # the block before the first and the one after the last may be in the folders beside, but not numbered as neighbours
        near = int(parts.min()), int(parts.max())
        found = blocks.search(Requests(vectors, *place, each, np.full(len(each), _MIN), np.full(len(each), _MAX), True, POSITIVES), near)
        positives = found.toArrow().sort_by([("req", "ascending"), ("rank", "ascending")])
        scores = positives["score"].to_pylist()
        low, high = (np.array(x, np.int64) for x in ([-(-LOW * s // 10) for s in scores], [HIGH * s // 10 for s in scores]))
        of = positives["req"].to_numpy()
        asked = Requests(vectors, *place, of, low, high, False, NEGATIVES)
        negatives = blocks.search(asked, near)
        named = pa.table({"req": pa.array(np.arange(len(of)), pa.int64()), "anchor_id": got["id"].take(pa.array(of)), "positive_id": positives["id"], "positive_known": positives["known"], "positive_score": positives["score"]})
        named = F.broadcast(spark.createDataFrame(named, "req long, anchor_id long, positive_id long, positive_known boolean, positive_score long"))
        rows = negatives.join(named, "req").select("anchor_id", _id(F.col("positive_known"), "positive_id").alias("positive_id"), "rank", _id(F.col("known")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.union(rows)
    return out
