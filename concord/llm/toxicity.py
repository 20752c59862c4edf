"""Operator 4: toxicity by nearest labelled examples.

A bounded sample of labelled texts is indexed as TF-IDF vectors over all terms that the sample has. A term's idf is
raised by how far its presence tells the labels apart; no term and no example is left out. Similar examples stand in
blocks, and the inverted index keeps each term's largest weight in each block beside its postings. These block maxima
bound a query's cosine with all examples of a block; only blocks whose bound passes the least of the nearest found so
far are looked into, so the nearest are exact. They are worked out again in double precision. Votes weighted by cosine
are calibrated on the examples, each left out of its own vote.

Defined results: null and empty texts, and texts without a word of the examples, get the calibrated prior; words that no
example has don't count; rows without a label teach nothing; an id labelled more than once is toxic if any label says
so, and of several texts of one id the first in order teaches; without labels every score is the prior 0; rows with
equal ids are scored one by one; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

#: Labelled examples indexed at most (of each label), terms whose postings are kept as a matrix, examples of a block on
#: average (twice that at most), neighbours that vote.
EXAMPLES = 2000
DENSE = 1024
BLOCK = 32
#: Queries whose postings are added up at once, so that what they take stays in a core's cache.
SLICE = 16
NEIGHBOURS = 15
#: Chi-squared that doubles a term's weight. Cosines this far below the least one are looked at again.
DOUBLES = 30.0
MARGIN = 1e-4

_WORD = re.compile(r"[^\W_]+")


def forms(word: str) -> list[str]:
    """What a word counts as: itself, and its first four letters where it has more (marked ^), as words of one stem come
    in many forms."""
    return [word, "^" + word[:4]] if len(word) > 4 else [word]


def terms(text: str) -> Counter:
    """How often each form of each word occurs."""
    words = Counter(_WORD.findall(text.lower()))
    out = Counter()
    for word, n in words.items():
        for form in forms(word):
            out[form] += n
    return out


class Known(dict):
    """The terms of each word by number. New terms enter the vocabulary if it learns."""

    def __init__(self, vocabulary: dict[str, int], learns: bool = False):
        super().__init__()
        self.vocabulary, self.learns = vocabulary, learns

    def __missing__(self, word: str) -> tuple[int, ...]:
        if self.learns:
            found = tuple(self.vocabulary.setdefault(f, len(self.vocabulary)) for f in forms(word))
        else:
            get = self.vocabulary.get
            whole, stem = get(word), get("^" + word[:4]) if len(word) > 4 else None
            found = (() if whole is None else (whole,)) if stem is None else (stem,) if whole is None else (whole, stem)
        self[word] = found
        return found

    def bag(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms and how often each occurs."""
        if not self.learns and len(self) > 300_000:
            self.clear()
        found = chain.from_iterable(map(self.__getitem__, _WORD.findall(text.lower())))
        return np.unique(np.fromiter(found, np.int64), return_counts=True)


def clusters(rows: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """The cluster of each row by cosine: k means, begun at evenly spaced rows."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        of = (rows @ centres.T).argmax(1)
        for j in range(k):
            mean = rows[of == j].sum(0)
            if norm := np.sqrt((mean * mean).sum()):
                centres[j] = mean / norm
    return of


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1, ... of each run, one run after the other."""
    if not len(count):
        return np.empty(0, np.int32)
    upto = np.cumsum(count, dtype=np.int32)
    return np.repeat(begin - upto + count, count) + np.arange(upto[-1], dtype=np.int32)


@dataclass
class Index:
    """Terms are numbered from the one of most examples on."""

    ids: np.ndarray
    labels: np.ndarray
    vocabulary: dict[str, int]
    idf: np.ndarray
    prior: float
    alpha: tuple[float, float] = (1.0, 0.0)

    def weighed(self, t: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of length 1: (1 + log tf) idf."""
        w = (1 + np.log(c)) * self.idf[t]
        norm = np.sqrt((w * w).sum())
        return t, w / norm if norm else w

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        got = sorted((self.vocabulary[w], c) for w, c in counts.items() if w in self.vocabulary)
        return self.weighed(np.array([t for t, _ in got], np.int64), np.array([c for _, c in got], np.float64))

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Blocks of similar examples, in order of which everything is held; the examples' vectors one after the other;
        the first DENSE terms as matrices of weights and of block maxima; for each other term its block maxima, each with
        the range of its block's postings."""
        n, size = len(vectors), len(self.vocabulary)
        common = np.zeros((n, min(DENSE, size)), np.float32)
        for row, (t, w) in zip(common, vectors):
            at = np.searchsorted(t, DENSE)
            row[t[:at]] = w[:at]
        of = clusters(common, max(1, n // BLOCK)) if n else np.empty(0, np.int64)
        order = np.argsort(of, kind="stable")
        self.ids, self.labels, common, vectors = self.ids[order], self.labels[order], common[order], [vectors[i] for i in order]
        sizes = [min(2 * BLOCK, c - at) for c in np.bincount(of) for at in range(0, c, 2 * BLOCK)]
        self.edge = np.cumsum([0, *sizes])
        block = np.repeat(np.arange(len(sizes)), sizes)
        self.start = np.cumsum([0, *(len(t) for t, _ in vectors)]).astype(np.int32)
        self.term = np.concatenate([*(t for t, _ in vectors), np.empty(0, np.int64)]).astype(np.int32)
        self.weight = np.concatenate([*(w for _, w in vectors), np.empty(0)])
        self.dense = np.ascontiguousarray(common.T)
        self.dense_max = np.maximum.reduceat(self.dense, self.edge[:-1], axis=1) if n else self.dense
        rare = self.term >= DENSE
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.start))[rare]
        by_term = np.argsort(self.term[rare], kind="stable")
        self.post, self.post_weight = example[by_term], self.weight[rare][by_term].astype(np.float32)
        key = self.term[rare][by_term].astype(np.int64) * max(1, len(sizes)) + block[self.post]
        first = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.empty(0, np.int64)
        self.range = np.append(first, len(key)).astype(np.int32)
        self.max_block = block[self.post[first]].astype(np.int32)
        self.max_weight = np.maximum.reduceat(self.post_weight, first) if len(first) else np.empty(0, np.float32)
        self.begin = np.searchsorted(key[first] // max(1, len(sizes)), np.arange(size + 1)).astype(np.int32)

    def _score(self, q: np.ndarray, rare: tuple, wanted: np.ndarray, out: np.ndarray) -> None:
        """Adds to out the cosines of queries (rows) and the examples of the blocks wanted."""
        for b in np.flatnonzero(wanted.any(0)):
            rows = np.flatnonzero(wanted[:, b])
            out[rows, self.edge[b] : self.edge[b + 1]] = q[rows] @ self.dense[:, self.edge[b] : self.edge[b + 1]]
        for first, row, entry, weight, block in rare:
            part = out[first : first + SLICE]
            kept = np.flatnonzero(wanted[first : first + SLICE].ravel()[row * np.int32(wanted.shape[1]) + block])
            begin = self.range[entry[kept]]
            count = self.range[entry[kept] + 1] - begin
            places = _runs(begin, count)
            at = np.repeat(row[kept] * np.int32(out.shape[1]), count) + self.post[places]
            part += np.bincount(at, np.repeat(weight[kept], count) * self.post_weight[places], part.size).reshape(part.shape)

    def nearest_all(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k examples of the largest cosine over 0, ties to the earlier example."""
        leave = [-1] * len(vectors) if leave is None else leave
        return [x for at in range(0, len(vectors), 64) for x in self._nearest(vectors[at : at + 64], k, np.array(leave[at : at + 64]))]

    def _nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each query's two blocks of the largest bounds are scored first; the kth best cosine there decides which others
        are."""
        n, m, blocks, out = len(self.ids), len(vectors), len(self.edge) - 1, []
        if not n:
            return [(np.empty(0, np.int64), np.empty(0)) for _ in vectors]
        q, split = np.zeros((m, len(self.dense)), np.float32), [np.searchsorted(t, DENSE) for t, _ in vectors]
        for row, (t, w), at in zip(q, vectors, split):
            row[t[:at]] = w[:at]
        bound, rare = q @ self.dense_max, []
        for at in range(0, m, SLICE):
            some = [(t[c:], w[c:]) for (t, w), c in zip(vectors[at : at + SLICE], split[at : at + SLICE])]
            term = np.concatenate([t for t, _ in some])
            begin = self.begin[term]
            count = self.begin[term + 1] - begin
            entry = _runs(begin, count)
            row = np.repeat(np.repeat(np.arange(len(some), dtype=np.int32), [len(t) for t, _ in some]), count)
            weight = np.repeat(np.concatenate([w for _, w in some]).astype(np.float32), count)
            block = self.max_block[entry]
            rare.append((at, row, entry, weight, block))
            bound[at : at + SLICE] += np.bincount(row * np.int32(blocks) + block, weight * self.max_weight[entry], len(some) * blocks).reshape(-1, blocks)
        first, near, least = np.zeros((m, blocks), bool), np.zeros((m, n), np.float32), np.zeros(m)
        first[np.arange(m)[:, None], np.argpartition(-bound, min(2, blocks - 1), axis=1)[:, :2]] = True
        gone = np.flatnonzero(leave >= 0)
        for wanted in (first, None):
            self._score(q, rare, (bound > least[:, None]) & ~first if wanted is None else wanted, near)
            near[gone, leave[gone]] = 0
            if n > k:
                least = np.maximum(0, np.partition(near, n - k, axis=1)[:, n - k] - MARGIN)
        full = np.zeros(len(self.vocabulary))
        for i, (t, w) in enumerate(vectors):
            found = np.flatnonzero(near[i] > least[i])
            if not len(found):
                out.append((found, np.empty(0)))
                continue
            full[t] = w
            size = self.start[found + 1] - self.start[found]
            places = _runs(self.start[found], size)
            cosines = np.add.reduceat(full[self.term[places]] * self.weight[places], np.cumsum(size) - size)
            full[t] = 0
            order = np.lexsort((found, -cosines))[:k]
            out.append((found[order], cosines[order]))
        return out

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_all([(t, w)], k, [leave])[0]

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """Neighbours' labels by cosine; the prior weighs as much as one neighbour at cosine 0.1."""
        return float((cosines @ self.labels[found] + 0.1 * self.prior) / (cosines.sum() + 0.1))

    def calibrated(self, vote: float) -> float:
        a, b = self.alpha
        v = np.clip(vote, 1e-4, 1 - 1e-4)
        return float(1 / (1 + np.exp(-np.clip(a * np.log(v / (1 - v)) + b, -30, 30))))

    def scores(self, texts: list[str], known: Known, k: int = NEIGHBOURS) -> list[tuple[float, np.ndarray, np.ndarray]]:
        if not self.prior:
            return [(0.0, np.empty(0, np.int64), np.empty(0))] * len(texts)
        got = self.nearest_all([self.weighed(*known.bag(t)) for t in texts], k)
        return [(self.calibrated(self.vote(found, cosines)), found, cosines) for found, cosines in got]


def relevance(seen: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> np.ndarray:
    """Factor of each term's idf, 1 or more: how far its presence (in seen of n examples, toxic of them of the n1 of label
    1) is associated with the label, by chi-squared."""
    n0 = n - n1
    if not n0 or not n1:
        return np.ones(len(seen))
    chi = (toxic - seen * n1 / n) ** 2 * n**3 / np.maximum(1e-9, seen * (n - seen) * float(n1) * n0)
    return 1 + np.where(seen < n, chi, 0) / DOUBLES


def fit(examples: list[tuple[int, str, int]], prior: float) -> Index:
    """examples: (doc_id, text, label). Those without a word are in the index too; nothing finds them."""
    first = {}
    known = Known(first, learns=True)
    examples = sorted(examples)
    bags = [known.bag(text) for _, text, _ in examples]
    labels = np.array([x[2] for x in examples], np.float64)
    every = np.concatenate([*(t for t, _ in bags), np.empty(0, np.int64)])
    seen = np.bincount(every, minlength=len(first)).astype(np.float64)
    toxic = np.bincount(every, np.repeat(labels, [len(t) for t, _ in bags]), len(first))
    order = np.argsort(-seen, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    idf = (np.log((1 + len(bags)) / (1 + seen)) + 1) * relevance(seen, toxic, len(bags), int(labels.sum()))
    index = Index(np.array([x[0] for x in examples], np.int64), labels, {w: int(place[i]) for w, i in first.items()}, idf[order], prior)
    vectors = []
    for t, c in bags:
        by_number = np.argsort(place[t])
        vectors.append(index.weighed(place[t][by_number], c[by_number]))
    del bags, known, every
    index.build(vectors)
    del vectors
    got, n = [], len(index.ids)
    for at in range(0, n, 64):
        some = [(index.term[a:b].astype(np.int64), index.weight[a:b]) for a, b in zip(index.start[at : at + 64], index.start[at + 1 : at + 65])]
        got += index.nearest_all(some, NEIGHBOURS, list(range(at, min(at + 64, n))))
    index.alpha = calibrate(np.array([index.vote(*x) for x in got]), index.labels, prior)
    return index


def calibrate(votes: np.ndarray, labels: np.ndarray, prior: float, rounds: int = 300) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the log-odds of votes; classes weigh as in the corpus."""
    if not len(votes) or labels.min() == labels.max():
        return 1.0, 0.0
    x = np.log(np.clip(votes, 1e-4, 1 - 1e-4) / (1 - np.clip(votes, 1e-4, 1 - 1e-4)))
    weight = np.where(labels == 1, prior / labels.sum(), (1 - prior) / (len(labels) - labels.sum()))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (p - labels), weight * p * (1 - p) + 1e-9
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * x).sum() + 1e-3 * (a - 1), g.sum() + 1e-3 * b])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def remainder(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5


def training(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> tuple[list[tuple[int, str, int]], float]:
    """At most most examples of each label, one for an id, those with the smallest MD5 of their id, and the share of label
    1 among all that may teach. Ids whose CRC-32 leaves remainder 0 by 5 never do."""
    usable = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label")).where("id is not null and label in (0, 1)").where(remainder("id") != 0)
    usable = usable.groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    chosen = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(F.md5(F.col("id").cast("string")), "id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).collect()
    return sorted((r["doc_id"], r["text"], r["label"]) for r in rows), (counts.get(1, 0) / total if total else 0.0)


def _scorer(index):
    shape = "struct<score:double,ids:array<long>,cosines:array<double>>"

    @F.arrow_udf(shape)
    def score(texts: pa.Array) -> pa.Array:
        own = index.value
        known = own.__dict__.setdefault("known", Known(own.vocabulary))  # for the batches of a worker
        got = own.scores([t or "" for t in texts.to_pylist()], known)
        ids = pa.array([own.ids[f].tolist() for _, f, _ in got], pa.list_(pa.int64()))
        cosines = pa.array([c.tolist() for _, _, c in got], pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array([s for s, _, _ in got], pa.float64()), ids, cosines], ["score", "ids", "cosines"])

    return score


def score(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, neighbours, cosines): a row per document, the neighbours as evidence."""
    small_batches(docs.sparkSession)
    examples, prior = training(docs, labels, most)
    index = docs.sparkSession.sparkContext.broadcast(fit(examples, prior))
    rows = docs.select("doc_id", (remainder() == 0).alias("held_out"), _scorer(index)(text_of()).alias("s"))
    rows = rows.select("doc_id", "held_out", F.col("s.score").alias("score"), F.col("s.ids").alias("neighbours"), F.col("s.cosines").alias("cosines"))
    return rows.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "neighbours", "cosines")
