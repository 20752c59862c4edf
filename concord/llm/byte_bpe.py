"""Operator 13: byte-level BPE encoding and decoding by ranks.

A text is split by the vocabulary's pattern. Distinct matches of a batch that the worker hasn't met are encoded
together: those that are tokens as they stand are done; the others are dealt by length into padded numpy matrices, a row
for each. In each round every row merges its leftmost pair of minimum rank; ranks of pairs come from an open-addressing
hash table, only the two pairs beside a merge are looked up anew, and both the merged cell and finished rows are
compacted away. Matches of more than LONG bytes are rows of their own: a round merges all occurrences of the minimum
pair from the left on, up to the first after which a lower rank appears, which is what merging them one by one does.

Before a space between two characters that are none a match always begins. What stands between such spaces is encoded
once and remembered, and texts are taken in pieces that end there, so that memory doesn't grow with the number of
matches of a text. Documents stay where they are: no shuffle.

Defined results: null and empty texts have no ids; every row is encoded by itself, so repeated rows and ids, null ids
and empty tables need no care; other columns than those to keep are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import small_batches, text_of

#: Matches of more bytes than this are merged alone.
LONG = 256
#: Cells in one matrix, characters taken at once, matches and stretches between spaces that a worker remembers.
CELLS, PIECE, REMEMBERED = 1 << 20, 1 << 20, 500_000

NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BORDER = re.compile(r"(?<=\S) (?=\S)")


class PairTable:
    """Ids of merged pairs by the ids of their parts: open addressing, at most a quarter full."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, _EMPTY), np.full(1 << bits, NONE)
        keys = np.array([a << 32 | b for a, b in pairs], np.uint64)
        values = np.array(list(pairs.values()), np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == _EMPTY
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            keys, values, slots = keys[~put], values[~put], slots[~put]
            taken = self.keys[slots] != _EMPTY
            slots = np.where(taken, (slots + 1) & self.mask, slots)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX >> self.shift).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids of the pairs merged, NONE where there is none; a negative id is a pad."""
        keys = a.astype(np.uint32).astype(np.uint64) << np.uint64(32) | b.astype(np.uint32)
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        left = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(left):
            slots[left] = (slots[left] + 1) & self.mask
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slots[left[hit]]]
            left = left[~hit & (found != _EMPTY)]
        return out


class Encoder:
    """ranks: the lines of a rank file (base64 of the token's bytes, rank); pattern: what matches of a text are encoded
    each by itself."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        if lacking := [i for i in range(256) if bytes([i]) not in self.ids]:
            raise ValueError(f"bytes without a token: {lacking}")
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.of_byte = np.array([self.ids[bytes([i])] for i in range(256)], np.int32)
        halves = ((self.ids.get(t[:i]), self.ids.get(t[i:]), rank) for t, rank in self.ids.items() for i in range(1, len(t)))
        self.pairs = PairTable({(a, b): rank for a, b, rank in halves if a is not None and b is not None})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def _matrix(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of each word, all of at most width bytes."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.of_byte[raw], np.int32(-1))
        pairs = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), -1)
        rows, out = np.arange(len(words)), [b""] * len(words)
        while len(rows):
            at = pairs.argmin(1) if pairs.shape[1] else np.zeros(len(rows), np.int64)
            best = pairs[np.arange(len(rows)), at] if pairs.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            for i in np.flatnonzero(done):
                line = ids[i]
                out[rows[i]] = line[line >= 0].tobytes()
            if done.any():
                rows, ids, pairs, at, best = (x[~done] for x in (rows, ids, pairs, at, best))
                if not len(rows):
                    break
            n, columns = np.arange(len(rows)), np.arange(ids.shape[1])
            ids[n, at] = best
            ids = ids[columns != at[:, None] + 1].reshape(len(rows), -1)
            pairs = pairs[columns[:-1] != at[:, None]].reshape(len(rows), -1)
            left = at > 0
            pairs[n[left], at[left] - 1] = self.pairs.get(ids[n[left], at[left] - 1], ids[n[left], at[left]])
            right = at < pairs.shape[1]
            pairs[n[right], at[right]] = self.pairs.get(ids[n[right], at[right]], ids[n[right], at[right] + 1])
        return out

    def _alone(self, word: bytes) -> bytes:
        """Ids of one long word."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)]
        pairs = self.pairs.get(ids[:-1], ids[1:])
        while len(pairs) and (best := pairs.min()) != NONE:
            at = np.flatnonzero(pairs == best)
            begins = np.concatenate([[True], np.diff(at) > 1])  # of neighbours in a row every second one can be merged
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))) % 2 == 0]
            merged = np.full(len(at), best)
            before = np.where(at > 0, ids[at - 1], -1)
            before[1:] = np.where(np.diff(at) == 2, best, before[1:])
            after = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            lower = np.flatnonzero((self.pairs.get(before, merged) < best) | (self.pairs.get(merged, after) < best))
            at = at[: lower[0] + 1] if len(lower) else at
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, pairs, at = ids[keep], pairs[keep[1:]], at - np.arange(len(at))
            for side in (at[at > 0] - 1, at[at < len(pairs)]):
                pairs[side] = self.pairs.get(ids[side], ids[side + 1])
        return ids.tobytes()

    def learn(self, words: Iterable[str]) -> None:
        """Encodes words that aren't known yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            if word not in self.known:
                raw = word.encode("utf-8", "surrogatepass")
                whole = self.ids.get(raw)
                if whole is not None:
                    self.known[word] = whole.to_bytes(4, "little")
                else:
                    buckets.setdefault(1 << (len(raw) - 1).bit_length(), []).append((word, raw))
        for width, found in buckets.items():
            if width > LONG:
                self.known.update((word, self._alone(raw)) for word, raw in found)
                continue
            step = CELLS // width
            for i in range(0, len(found), step):
                part = found[i : i + step]
                self.known.update(zip([w for w, _ in part], self._matrix([raw for _, raw in part], width), strict=True))

    def _words(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for taken in _taken((i, p) for i, t in enumerate(texts) for p in pieces(t, PIECE)):
            if len(self.stretches) > REMEMBERED:
                self.stretches.clear()
            split = [_BORDER.split(p) for _, p in taken]
            new = list(set().union(*(s[1:] for s in split)) - self.stretches.keys())
            heads = self._words([s[0] for s in split] + [" " + s for s in new])
            self.stretches.update(zip(new, heads[len(split) :], strict=True))
            for (i, _), head, s in zip(taken, heads, split):
                out[i].append(head)
                out[i].extend(map(self.stretches.__getitem__, s[1:]))
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def pieces(text: str, size: int) -> Iterator[str]:
    """A text in parts of about size characters, cut before a space between two characters that are none."""
    begin = 0
    while len(text) - begin > size and (m := _BORDER.search(text, begin + size)):
        yield text[begin : m.start()]
        begin = m.start()
    yield text[begin:]


def _taken(parts: Iterable[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Parts in groups of about PIECE characters."""
    group, n = [], 0
    for part in parts:
        group.append(part)
        n += len(part[1])
        if n >= PIECE:
            yield group
            group, n = [], 0
    if group:
        yield group


@functools.lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def read_ranks(path: str) -> bytes:
    """A rank file, read where the driver runs; it is sent to the tasks whole, a few megabytes for any vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to keep with n_tokens and ids (binary: little-endian unsigned 32-bit integers), a row per document."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(*keep, text_of().alias("text"))

    def run(batches):
        encoder = _encoder(sent.value, pattern)
        for batch in batches:
            ids = encoder.encode(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], [*keep, "n_tokens", "ids"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[: len(keep)], StructField("n_tokens", LongType()), StructField("ids", BinaryType())]))


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """encoded (with ids) and decoded, the bytes of its ids; null ids give no bytes."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)
    place = encoded.columns.index("ids")

    def run(batches):
        encoder = _encoder(sent.value, pattern)
        for batch in batches:
            texts = [encoder.decode(x or b"") for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what encoding gives and what decoding makes of it."""
    rows = decode(encode(docs, ranks, pattern), ranks, pattern)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
