"""Operator 12: alignment of two tokenizers, A (byte-level BPE) and B (pieces with byte fallback), over the same bytes.

Where tokens of A and B both end, a cut divides them into groups; an A and a B token are linked where their bytes
overlap. A pair of ids counts once for each document that holds it linked.

Before a space between two characters that are none, tokens of either side always begin (no token of B has a space after
another character; vocabularies with one are refused). What stands between such spaces is tokenized and aligned once and
remembered. A document of more than CHUNK bytes is cut there into pieces, which are dealt over tasks; the tokens of a
piece are dealt by fixed byte ranges, wherever these end, into fragments: an open head (tokens before the range's first
cut), closed groups, an open tail (from its last cut on). Fragments are a monoid under compose(): head and tail that meet
become a group. A tree of groupings, FAN to one in each round, composes those of a document; closed groups leave it at
once, so that what is composed stays a few tokens wide.

Counts of pairs are summed in each task before they are shuffled. Each document keeps its own pairs with their numbers of
occurrences, stored; the table of counts is sent to all tasks in slices of at most SLICE pairs, a pass over the stored
pairs for each slice (the second pass adds to what the first has found).

Defined results: null and empty texts, and texts whose bytes the tokens of a side don't give back, have no tokens: zeros
and an empty string of groups. Rows are documents: repeated rows, repeated and null ids count and are returned each by
itself. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .byte_bpe import _BORDER, pieces
from .common import Tables, small_batches, text_of

#: Bytes of a range (longer documents are dealt in such ranges), fragments composed into one in a round of the tree.
CHUNK, FAN = 1 << 16, 8  # CHUNK below 2^20
#: Stretches that a worker remembers; pairs sent to all tasks at once (13 bytes each).
REMEMBERED, SLICE = 500_000, 4_000_000

#: Places of three counts in one number, each below 2^20 as a document of this path is shorter, and what marks no tokens.
_A, _B, _BAD = 1 << 40, 1 << 20, 1 << 62
_FIELD = _B - 1


def byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies write bytes: visible Latin-1 characters stand for themselves, the others in order for
    the characters from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens(NamedTuple):
    """Tokens of both sides as rows of id, begin and end in bytes."""

    a: np.ndarray
    b: np.ndarray

    def between(self, lo: int, hi: int) -> Tokens:
        """Those that begin from lo on and before hi."""
        return Tokens(*(x[np.searchsorted(x[:, 1], lo) : np.searchsorted(x[:, 1], hi)] for x in self))

    def then(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self, other, strict=True)))

    def cuts(self) -> np.ndarray:
        """Where tokens of both sides begin."""
        return np.intersect1d(self.a[:, 1], self.b[:, 1])

    def links(self) -> np.ndarray:
        """Pairs of ids, a << 32 | b, of all overlapping tokens of whole groups."""
        begins = np.union1d(self.a[:, 1], self.b[:, 1])
        of = [x[np.searchsorted(x[:, 1], begins, side="right") - 1, 0] for x in self]
        return of[0] << 32 | of[1]

    def spelled(self) -> str:
        """Groups as text."""
        at = self.cuts()
        parts = [[",".join(map(str, g)) for g in np.split(x[:, 0], np.searchsorted(x[:, 1], at[1:]))] for x in self]
        return ";".join(map("|".join, zip(*parts, strict=True)))


NO_TOKENS = Tokens(*(np.empty((0, 3), np.int64) for _ in "ab"))


class Fragment(NamedTuple):
    """Consecutive tokens of a document. Without a cut all are in head and tail is empty. joints: the groups that composing
    has closed, in order."""

    cut: bool
    head: Tokens
    tail: Tokens
    joints: tuple[Tokens, ...] = ()


EMPTY = Fragment(False, NO_TOKENS, NO_TOKENS)


def compose(x: Fragment, y: Fragment) -> Fragment:
    """What x and then y are together. Associative, EMPTY is neutral."""
    joints = x.joints + y.joints
    if not x.cut:
        return Fragment(y.cut, x.head.then(y.head), y.tail, joints)
    if not y.cut:
        return Fragment(True, x.head, x.tail.then(y.head), joints)
    return Fragment(True, x.head, y.tail, (*x.joints, x.tail.then(y.head), *y.joints))


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """The fragment of what begins in a range, and its closed groups."""
    at = tokens.cuts()
    if not len(at):
        return Fragment(False, tokens, NO_TOKENS), NO_TOKENS
    end = 1 << 62
    return Fragment(True, tokens.between(0, at[0]), tokens.between(at[-1], end)), tokens.between(at[0], at[-1])


class Aligner:
    """a: a tokenizer's JSON, b: a model of pieces, as the libraries read them."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_buffer(a), sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        of = byte_of_character()
        self.a_bytes = {i: bytes(map(of.__getitem__, t)) if all(c in of for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if odd := [p for p in names if re.search("[^▁]▁", p)]:
            raise ValueError(f"pieces with a space within: {odd[:5]}")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        lengths = {i: len(t) for i, t in self.a_bytes.items()}
        self.a_length = np.array([lengths.get(i, 0) for i in range(max(lengths) + 1)])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        self.names = np.array([str(i) for i in range(max(len(self.a_length), len(self.b_length)))], object)
        self.known: dict[str, tuple[bytes, bytes, int]] = {}

    def _encoded(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of both sides, and whether both give a stretch back. All are compared in one go; only if something differs
        is each looked at."""
        spaced = [" " + s for s in stretches]
        a = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b = self.b.encode(stretches, num_threads=1)
        raw = [s.encode("utf-8", "surrogatepass") for s in spaced]
        ends = np.cumsum(list(map(len, raw)))
        whole, same = b"".join(raw), True
        for ids, of, lengths in ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length)):
            flat = list(chain.from_iterable(ids))
            at = np.cumsum(lengths[flat])[np.cumsum(list(map(len, ids))) - 1] if flat else np.empty(0)
            same = same and np.array_equal(at, ends) and b"".join(map(of.__getitem__, flat)) == whole
        if same:
            return a, b, [True] * len(raw)
        side = lambda ids, of: b"".join(map(of.__getitem__, ids))
        return a, b, [side(i, self.a_bytes) == r == side(j, self.b_bytes) for i, j, r in zip(a, b, raw, strict=True)]

    def learn(self, stretches: list[str]) -> None:
        """Aligns stretches, all in one go: their groups as text, pairs of ids, and how many tokens and groups, in one
        number. Laid end to end they are one document, with a cut at each end."""
        if not stretches:
            return
        a, b, back = self._encoded(stretches)
        self.known.update((s, (b"", b"", _BAD)) for s, ok in zip(stretches, back, strict=True) if not ok)
        good = [x for x, ok in zip(zip(stretches, a, b, strict=True), back, strict=True) if ok]
        if not good:
            return
        ids, ends, at = [], [], []
        for side, lengths in ((1, self.a_length), (2, self.b_length)):
            ids.append(np.array(list(chain.from_iterable(x[side] for x in good)), np.int64))
            ends.append(np.cumsum(lengths[ids[-1]]))
            at.append(np.cumsum([0, *(len(x[side]) for x in good)]))
        cuts = np.intersect1d(*ends, assume_unique=True)
        of = [np.searchsorted(cuts, e) for e in ends]  # the group of each token
        firsts = [np.searchsorted(g, np.arange(len(cuts))) for g in of]
        stretch_ends = ends[0][at[0][1:] - 1]
        begins = np.unique(np.concatenate([[0], *(e[:-1] for e in ends)]))
        pairs = ids[0][np.searchsorted(ends[0], begins, side="right")] << 32 | ids[1][np.searchsorted(ends[1], begins, side="right")]
        links = np.concatenate([[0], np.searchsorted(begins, stretch_ends)]) * 8
        groups = np.concatenate([[0], np.searchsorted(cuts, stretch_ends) + 1])
        # as text: tokens of A and B of each group in turn, every one followed by what parts it from the next
        line = np.empty(2 * (len(ids[0]) + len(ids[1])), object)
        for side, other in ((0, 1), (1, 0)):
            before = firsts[other][of[side]] if side == 0 else np.append(firsts[0], len(ids[0]))[of[1] + 1]
            place = 2 * (np.arange(len(ids[side])) + before)
            line[place] = self.names[ids[side]]
            mark = np.full(len(ids[side]), ",", object)
            mark[np.append(firsts[side][1:], len(ids[side])) - 1] = "|" if side == 0 else ";"
            if side:
                mark[at[1][1:] - 1] = "\n"
            line[place + 1] = mark
        raw = pairs.tobytes()
        lines = "".join(line.tolist()).encode().split(b"\n")
        numbers = zip(np.diff(at[0]).tolist(), np.diff(at[1]).tolist(), np.diff(groups).tolist(), strict=True)
        for (s, _, _), text, lo, hi, (n_a, n_b, n) in zip(good, lines, links.tolist(), links[1:].tolist(), numbers, strict=False):
            self.known[s] = text, raw[lo:hi], n_a * _A + n_b * _B + n

    def align(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, int, int, int]]:
        """Of each text: groups, pairs of all links, tokens of A and B, number of groups."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [_BORDER.split(t) if t else [] for t in texts]
        self.learn(list(set().union(*split) - self.known.keys()))
        for stretches in split:
            found = list(map(self.known.__getitem__, stretches))
            n = sum(map(itemgetter(2), found))
            if not found or n >= _BAD:
                yield b"", np.empty(0, np.int64), 0, 0, 0
            else:
                yield b";".join(map(itemgetter(0), found)), np.frombuffer(b"".join(map(itemgetter(1), found)), np.int64), n // _A, n // _B & _FIELD, n & _FIELD

    def tokens(self, piece: str, begin: int) -> Tokens | None:
        """Tokens of a piece that begins (with a space) at a byte of its document; None if they don't give it back."""
        *encoded, back = self._encoded(_BORDER.split(piece))
        if not all(back):
            return None
        sides = []
        for of, lengths in zip(encoded, (self.a_length, self.b_length), strict=True):
            ids = np.array(list(chain.from_iterable(of)), np.int64)
            ends = begin + np.cumsum(lengths[ids])
            sides.append(np.stack([ids, np.concatenate([[begin], ends[:-1]]), ends], 1))
        return Tokens(*sides)


@functools.lru_cache(maxsize=2)
def _aligner(a: bytes, b: bytes) -> Aligner:
    return Aligner(a, b)


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate([*values, np.empty(0, np.int64)]), kind))


_SHORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def _short(sent, digest: bool):
    import hashlib

    def run(batches):
        aligner = _aligner(*sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, pairs, times, groups = [], [], [], []
            for text, links, n_a, n_b, n in aligner.align(texts):
                found, count = np.unique(links, return_counts=True)
                rows.append((n_a, n_b, n, len(links)))
                pairs.append(found)
                times.append(count)
                groups.append((hashlib.sha256(text).hexdigest() if text else "") if digest else text.decode())
            numbers = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(groups, pa.string()), _lists(pairs, pa.int64()), _lists(times, pa.int32())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return run


def _pieces(chunk: int):
    """(key, begin, text): pieces of a text, begin counted in bytes with the space that is put before the text."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                begin = 0
                for i, p in enumerate(pieces(text, chunk)):
                    body = p if i == 0 else p[1:]
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([begin], pa.int64()), pa.array([body], pa.string())], ["key", "begin", "text"])
                    begin += 1 + len(body.encode("utf-8", "surrogatepass"))

    return run


#: A fragment (range: the number of its byte range, cut and four binaries of tokens) or, where range is null, groups.
_FRAGMENT = "key long, begin long, range long, cut boolean, head_a binary, head_b binary, tail_a binary, tail_b binary, groups string, pairs array<long>, n_a long, n_b long, n_groups long"
_NAMES = [c.split()[0] for c in _FRAGMENT.split(", ")]


def _closed(key: int, tokens: Tokens) -> tuple:
    return key, int(tokens.a[0, 1]), None, None, None, None, None, None, tokens.spelled(), tokens.links(), len(tokens.a), len(tokens.b), len(tokens.cuts())


def _open(key: int, begin: int, place: int, f: Fragment) -> tuple:
    return key, begin, place, f.cut, *(x.tobytes() for side in (f.head, f.tail) for x in side), None, None, 0, 0, 0


def _leaves(sent, chunk: int):
    """Fragments and closed groups of pieces, by byte range. A piece that its tokens don't give back has no fragment but a
    row of groups that are null."""

    def run(frames):
        aligner = _aligner(*sent.value)
        for frame in frames:
            rows = []
            for key, begin, text in zip(frame["key"], frame["begin"], frame["text"], strict=True):
                tokens = aligner.tokens(text, begin)
                if tokens is None:
                    rows.append((key, begin, *[None] * 8, 0, 0, 0))
                    continue
                for place in range(begin // chunk, (int(tokens.a[-1, 2]) - 1) // chunk + 1):
                    part, closed = fragment(tokens.between(place * chunk, (place + 1) * chunk))
                    rows.append(_open(key, max(begin, place * chunk), place, part))
                    if len(closed.a):
                        rows.append(_closed(key, closed))
            yield pd.DataFrame(rows, columns=_NAMES).astype({"range": "Int64", "cut": "boolean"})

    return run


def _branch(last: bool):
    """One fragment of those of a document that meet in a round, and the groups that it closes; the last round closes the
    tail too."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("begin")
        rows_of = lambda x: np.frombuffer(x, np.int64).reshape(-1, 3)
        whole = EMPTY
        for cut, *sides in zip(*(frame[c] for c in ("cut", "head_a", "head_b", "tail_a", "tail_b")), strict=True):
            a, b, c, d = map(rows_of, sides)
            whole = compose(whole, Fragment(bool(cut), Tokens(a, b), Tokens(c, d)))
        key, begin, place = int(frame["key"].iloc[0]), int(frame["begin"].iloc[0]), int(frame["range"].iloc[0]) // FAN
        rows = [_closed(key, t) for t in whole.joints]
        rows += [_closed(key, whole.tail)] if last and len(whole.tail.a) else [_open(key, begin, place, whole._replace(joints=()))] if not last else []
        return pd.DataFrame(rows, columns=_NAMES).astype({"range": "Int64", "cut": "boolean"})

    return run


def _long_groups(long: DataFrame, sent, chunk: int, tables: Tables) -> DataFrame:
    """(key, begin, groups, pairs, n_a, n_b, n_groups): groups of documents (key, text) in parts."""
    parts = long.mapInArrow(_pieces(chunk), "key long, begin long, text string").repartition(max(2, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "key", "begin")
    level = tables.put(parts.mapInPandas(_leaves(sent, chunk), _FRAGMENT))
    top = level.agg(F.max("range")).first()[0]
    out = level.where("range is null")
    while top is not None:
        last = top < FAN
        level = tables.put(level.where("range is not null").groupBy("key", F.expr(f"range div {FAN}")).applyInPandas(_branch(last), _FRAGMENT))
        out = out.union(level.where("range is null"))
        top = None if last else top // FAN
    return out.select("key", "begin", "groups", "pairs", "n_a", "n_b", "n_groups")


def _scores(table):
    """Adds to n_best and count_sum what a slice of the table of counts holds of a row's pairs."""

    def run(batches):
        keys, counts, best = table.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            pairs = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            add = lambda each: np.diff(np.concatenate([[0], np.cumsum(np.where(hit, each * times, 0))])[ends])
            values = {"count_sum": add(counts[at] if len(keys) else 0), "n_best": add(best[at].astype(np.int64) if len(keys) else 0)}
            columns = [pa.array(batch.column(n).to_numpy() + values[n], pa.int64()) if n in values else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def _scored(rows: DataFrame, counts: DataFrame, tables: Tables) -> DataFrame:
    """rows (with pairs and times) and n_best, count_sum, by passes over slices of counts (pair, n, best)."""
    spark = rows.sparkSession
    rows = rows.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    slices = max(1, -(-counts.count() // SLICE))
    for i in range(slices):
        part = counts if slices == 1 else counts.where(F.pmod(F.xxhash64("pair"), F.lit(slices)) == i)
        got = part.toArrow()
        order = np.argsort(got["pair"].to_numpy())
        sent = spark.sparkContext.broadcast(tuple(got[c].to_numpy()[order] for c in ("pair", "n", "best")))
        rows = rows.mapInArrow(_scores(sent), rows.schema)
        if i < slices - 1:
            rows = tables.put(rows)
    return rows


def align(docs: DataFrame, a: bytes, b: bytes, digest: bool = False, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): groups as text (a1,a2|b1;a3|b2,b3), or with digest
    as the SHA-256 of it, empty where there are none. n_links: links; n_best: those whose pair's count is the highest of
    its A id; count_sum: the sum of their pairs' counts."""
    spark = docs.sparkSession
    small_batches(spark)
    tables = Tables(spark, "tokens")
    sent = spark.sparkContext.broadcast((a, b))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    is_long = F.octet_length("text") > chunk
    short = tables.put(rows.where(~is_long).mapInArrow(_short(sent, digest), _SHORT))
    long = tables.put(rows.where(is_long).withColumn("key", F.monotonically_increasing_id()))
    some = not long.isEmpty()
    pairs = short.select(F.explode("pairs").alias("pair"))
    if some:
        parts = tables.put(_long_groups(long, sent, chunk, tables))
        good = parts.groupBy("key").agg(F.bool_and(F.col("groups").isNotNull()).alias("good")).where("good").select("key")
        parts = parts.join(good, "key", "left_semi")
        linked = tables.put(parts.select("key", F.explode("pairs").alias("pair")).groupBy("key", "pair").agg(F.count(F.lit(1)).alias("times")))
        pairs = pairs.union(linked.select("pair"))
    counts = tables.put(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    of_a = F.shiftright("pair", 32)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    counts = tables.put(counts.withColumn("a", of_a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    out = _scored(short, counts, tables).select(*columns)
    if some:
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "groups"))), lambda x: x["groups"]), ";")
        spelled = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")], text.alias("groups"))
        total = linked.join(counts, "pair").groupBy("key").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        found = long.select("doc_id", "key").join(spelled.join(total, "key"), "key", "left").fillna(0, columns[1:-1])
        found = found.withColumn("groups", F.coalesce(F.sha2("groups", 256) if digest else F.col("groups"), F.lit("")))
        out = out.union(found.select(*columns))
    return out


def read_models(a: str, b: str) -> tuple[bytes, bytes]:
    """Both files, read where the driver runs; they are sent to the tasks whole, a few megabytes for any vocabulary."""
    with open(a, "rb") as f, open(b, "rb") as g:
        return f.read(), g.read()
