"""Operator 6: benchmark decontamination by q-gram lemma filtering.

Items and documents are compared as lower-case words with one space between two. A region of a document that is an
item with at most k edits shares at least m + 1 - q - k q q-grams with it (m: the item's length), on diagonals that
differ by at most k. So q-grams that a document shares with each item are counted in bands of diagonals, of width
2 (k + 1) by the item's own k and each half over the next, and only bands that reach the bound are aligned. Bands in a
row are aligned as one. Shared q-grams are counted a bounded number at a time, and a band is settled, and dropped unless
it reaches the bound, as soon as the text has passed the last place that could fall into it: what is held at once is
bounded by the benchmark's block, whatever the length of a text and however often text and item repeat a phrase.

The benchmark is taken in blocks of bounded size. One block is matched in a single pass over the documents; more blocks
are a pass each, of which only texts with a match are stored, under the MD5 of the text.

Defined results: null and empty texts are clean; items shorter than min_item characters or without words are never
looked for; rows with equal ids are judged one by one; equal items are found both; an empty table of documents gives
an empty result, an empty benchmark leaves all clean; extra columns pass through filter_clean and don't matter else.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, free_name, small_batches, text_of

Q = 10
#: Edits allowed for each character of an item, and the shortest item looked for (a shorter one would share no q-gram).
EDIT_RATE = 0.05
MIN_ITEM = 30
#: Characters of benchmark in one block. A larger benchmark takes several passes over the documents.
BLOCK_CHARS = 8_000_000

#: Shared q-grams counted at a time.
PAIRS = 1_000_000

_NO_WORD = re.compile(r"[\W_]+")
_BITS = 22


def normalised(text: str) -> str:
    return _NO_WORD.sub(" ", text.lower()).strip()


def budget(m: int, rate: float) -> int:
    return int(m * rate)


def bound(m: int, rate: float, q: int) -> int:
    """q-grams that a region within the budget shares at least."""
    k = budget(m, rate)
    return m + 1 - q - k * q


def gram_hashes(text: str, q: int) -> np.ndarray:
    """Hashes of all q-grams, in order; q even steps of doubling and adding."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(chars) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    power, part, width, size, out = 0x100000001B3, chars, 1, 0, None
    left = q
    while left:
        if left & 1:
            piece = part[size : size + n]
            out = piece.copy() if out is None else out * np.uint64(power) + piece
            size += width
        left >>= 1
        if left:
            part = part[: len(part) - width] * np.uint64(power) + part[width:]
            power, width = power * power % (1 << 64), 2 * width
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(31))


@dataclass
class Index:
    """q-grams of the items of a block: a table of bits, and for each q-gram the items and places that have it."""

    ids: np.ndarray
    texts: list[str]
    rate: float
    q: int

    def __post_init__(self):
        grams = [gram_hashes(t, self.q) for t in self.texts]
        all_ = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(all_, kind="stable")
        self.grams, self.item, self.place = all_[order], item[order].astype(np.int32), place[order].astype(np.int32)
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self.grams >> np.uint64(64 - _BITS)] = True
        self.bounds = np.array([bound(len(t), self.rate, self.q) for t in self.texts], np.int64)
        self.half = np.array([budget(len(t), self.rate) + 1 for t in self.texts], np.int64)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.least = int(self.bounds.min()) if len(self.bounds) else 1 << 60

    def bands(self, text: str) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, diagonals) of each run of bands that reach the bound of their item."""
        h = gram_hashes(text, self.q)
        at = np.flatnonzero(self.bits[h >> np.uint64(64 - _BITS)])
        if len(at) < self.least:
            return []
        lo = np.searchsorted(self.grams, h[at])
        count = np.searchsorted(self.grams, h[at], side="right") - lo
        upto = np.cumsum(count)
        if upto[-1] < self.least:
            return []
        keys, n, begin, settled = np.empty(0, np.int64), np.empty(0, np.int64), 0, []
        while begin < len(at):
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, side="right")))
            found = self._counted(at[begin:end], lo[begin:end], count[begin:end])
            keys, back = np.unique(np.concatenate([keys, found[0]]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n, found[1]]), len(keys)).astype(np.int64)
            begin = end
            if begin < len(at):
                item = keys >> 40
                over = ((keys & ((1 << 40) - 1)) - (1 << 32) + 2) * self.half[item] + self.lengths[item] <= at[begin]
                settled.append(keys[over & (n >= self.bounds[item])])
                keys, n = keys[~over], n[~over]
        settled.append(keys[n >= self.bounds[keys >> 40]])
        keys = np.sort(np.concatenate(settled)) if len(settled) > 1 else settled[0]
        out: list[tuple[int, int, int]] = []
        for key in keys.tolist():
            item, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 32)
            half = int(self.half[item])
            if out and out[-1][0] == item and out[-1][1] + out[-1][2] >= band * half + half:
                out[-1] = (item, out[-1][1], (band + 2) * half - out[-1][1])
            else:
                out.append((item, band * half, 2 * half))
        return out

    def _counted(self, at: np.ndarray, lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys (item, band) and how many q-grams at these places of the text fall into each."""
        where = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item = self.item[where].astype(np.int64)
        band = (np.repeat(at, count) - self.place[where]) // self.half[item] + (1 << 32)
        keys, n = np.unique(item * (1 << 40) + band, return_counts=True)
        both, back = np.unique(np.concatenate([keys, keys - 1]), return_inverse=True)
        return both, np.bincount(back, np.concatenate([n, n]), len(both)).astype(np.int64)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of each item within its budget: its best place in the normalised text, the first of
        several."""
        best: dict[int, tuple[int, int, int]] = {}
        for item, low, width in self.bands(text):
            if item in best and best[item][0] == 0:
                continue
            pattern = self.texts[item]
            k = budget(len(pattern), self.rate)
            begin, end = max(0, low - k), min(len(text), low + width + len(pattern) + k)
            exact = text.find(pattern, begin, end)
            hit = (0, exact, exact + len(pattern)) if exact >= 0 else banded(pattern, text[begin:end], low - begin, width, k, begin)
            if hit and (item not in best or hit < best[item]):
                best[item] = hit
        return sorted((int(self.ids[i]), *hit) for i, hit in best.items())


def banded(pattern: str, region: str, low: int, width: int, k: int, begin: int) -> tuple[int, int, int] | None:
    """Least edits between the pattern and a part of region, over diagonals from low - k to low + width + k; (edits,
    start, end) shifted by begin, or None beyond k edits."""
    code = lambda s: np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    p, r = code(pattern), code(region)
    size = width + 2 * k + 1
    first = low - k
    far = np.int64(1 << 30)
    offsets = np.arange(size)
    ends = first + offsets  # column (end in region) of each cell, in row 0
    row = np.where((ends >= 0) & (ends <= len(r)), 0, far)
    start = ends.copy()
    for i in range(len(p)):
        ends = ends + 1
        inside = (ends >= 1) & (ends <= len(r))
        same = np.zeros(size, bool)
        same[inside] = r[ends[inside] - 1] == p[i]
        diagonal = np.where(inside, row + ~same, far)
        up = np.append(row[1:] + 1, far)
        up = np.where((ends >= 0) & (ends <= len(r)), up, far)
        up_start = np.append(start[1:], 0)
        new = np.minimum(diagonal, up)
        new_start = np.where(diagonal <= up, start, up_start)
        shifted = new - offsets
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, offsets, 0))
        row = np.where(ends <= len(r), least + offsets, far)
        start = new_start[source]
        if row.min() > k:
            return None
    j = int(row.argmin())
    return (int(row[j]), int(start[j]) + begin, int(ends[j]) + begin) if row[j] <= k else None


RESULT = "struct<item_ids:array<long>,edits:array<int>,starts:array<int>,ends:array<int>>"


def _matcher(index):
    fields = [("item_ids", pa.list_(pa.int64())), ("edits", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]

    @F.arrow_udf(RESULT)
    def matches(texts: pa.Array) -> pa.Array:
        own = index.value
        found = [own.matches(normalised(t or "")) for t in texts.to_pylist()]
        columns = [pa.array([[m[i] for m in x] for x in found], kind) for i, (_, kind) in enumerate(fields)]
        return pa.StructArray.from_arrays(columns, [name for name, _ in fields])

    return matches


def index_blocks(benchmark: DataFrame, rate: float, q: int, min_item: int, block_chars: int):
    """Indexes of the benchmark, block by block; the driver holds the items of one block at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).where("item_id is not null")
    ids, texts, chars = [], [], 0
    for row in items.toLocalIterator():
        text = normalised(row["text"])
        if len(text) >= min_item and bound(len(text), rate, q) > 0:
            ids.append(row["item_id"])
            texts.append(text)
            chars += len(text)
        if chars >= block_chars:
            yield Index(np.array(ids), texts, rate, q)
            ids, texts, chars = [], [], 0
    if texts:
        yield Index(np.array(ids), texts, rate, q)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, q: int = Q, min_item: int = MIN_ITEM, block_chars: int = BLOCK_CHARS, as_: str = "leaks") -> DataFrame:
    """All rows and columns of docs and as_: an array of (item_ids, edits, starts, ends), one for each block with a match."""
    small_batches(docs.sparkSession)
    context, tables = docs.sparkSession.sparkContext, Tables(docs.sparkSession, "leaks")
    blocks = index_blocks(benchmark, rate, q, min_item, block_chars)
    index, following = next(blocks, None), next(blocks, None)
    if index is None:
        return docs.withColumn(as_, F.array().cast(f"array<{RESULT}>"))
    if following is None:
        return docs.withColumn(as_, F.filter(F.array(_matcher(context.broadcast(index))(text_of())), lambda x: F.size(x["item_ids"]) > 0))
    hits = []
    while index is not None:
        shared = context.broadcast(index)
        found = docs.select(text_of().alias("text")).withColumn("m", _matcher(shared)(F.col("text"))).where(F.size("m.item_ids") > 0)
        hits.append(tables.put(found.select(F.md5("text").alias("key"), "m").dropDuplicates(["key"])))
        shared.destroy()
        index, following = following, next(blocks, None)
    key, of = free_name(docs, "text_key"), free_name(docs, "text_of")
    every = reduce(DataFrame.union, hits).groupBy(F.col("key").alias(of)).agg(F.array_sort(F.collect_list("m")).alias(as_))
    rows = docs.withColumn(key, F.md5(text_of())).join(every, F.col(key) == F.col(of), "left").drop(key, of)
    return rows.withColumn(as_, F.coalesce(as_, F.array().cast(f"array<{RESULT}>")))


def report(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, least_edits, starts, ends): a row per document."""
    rows = find_leaks(docs.select("doc_id", "text"), benchmark, **parameters)
    get = lambda name: F.flatten(F.transform("leaks", lambda x: x[name]))
    rows = rows.select("doc_id", *[get(name).alias(name) for name in ("item_ids", "edits", "starts", "ends")])
    n = F.size("item_ids").cast("long")
    return rows.select("doc_id", (n > 0).alias("contaminated"), n.alias("n_items"), "item_ids", F.array_min("edits").alias("least_edits"), "starts", "ends")


def filter_clean(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """Rows of docs without a leaked item."""
    leaks = free_name(docs, "leaks")
    return find_leaks(docs, benchmark, as_=leaks, **parameters).where(F.size(leaks) == 0).drop(leaks)
