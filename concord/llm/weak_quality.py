"""Operator 1: quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation over the counts of vote patterns
estimates each labeller's accuracy without any given label, which gives a posterior for every pattern. Posteriors of a
bounded sample of distinct texts out of all train a logistic scorer over hashed features of word shapes, which scores
every document.

Defined results: null and empty texts get the score of a text without features, that of the labellers' prior, and are
kept or not by it; rows with equal ids are scored one by one; an empty table gives an empty result; extra columns pass
through filter_good.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, free_name, let, small_batches, text_of, words_of

#: Documents in the sample that trains the scorer, the scorer's dimensions, and the score from which a text is good.
SAMPLE_ROWS = 3000
DIMENSIONS = 1 << 12
GOOD = 0.5
#: Words over which variety is taken, as longer prose repeats more of its words; words of a passage that comes again.
STRETCH = 2000
PASSAGE = 5


def labellers() -> dict[str, Column]:
    """Votes (1 good, 0 bad, -1 none) over columns text, words and hashes (of the words). Those that look for one fault say nothing where they
    don't see it; only the two that look for prose vote both ways."""
    n = F.greatest(F.size("words"), F.lit(1)).cast("double")
    part = lambda pattern: F.regexp_count("text", F.lit(pattern)) / n
    bad = lambda share, least: F.when(share > least, 0).otherwise(-1)
    both = lambda low, high: F.when(low, 0).when(high, 1).otherwise(-1)
    repeats = F.size(F.filter("hashes", lambda h, i: h == F.get("hashes", i - 1))) / n
    distinct = lambda key: F.size(F.array_distinct(F.transform("hashes", key))) / n
    variety = distinct(lambda h, i: F.xxhash64(h, F.floor(i / F.lit(STRETCH))))
    fresh = distinct(lambda h, i: F.xxhash64(h, *(F.get("hashes", i + k) for k in range(1, PASSAGE))))
    return {
        "symbols": bad(part(r"[#*$%&|<>]"), 0.25),
        "repeats": bad(repeats, 0.25),
        "capitals": bad(part(r"\p{Lu}{2,}"), 0.5),
        "marks": bad(part(r"[!?]{2,}"), 0.3),
        "separators": bad(part(r"(?<=\s)\|(?=\s)"), 0.15),
        "variety": F.when((n > 60) & ((variety < 0.2) | (fresh < 0.2)), 0).otherwise(-1),
        "sentences": let(part(r"[\p{L}\p{N}][.?](?!\S)"), lambda x: both((x < 0.004) & (n > 60), (x > 0.02) & (x < 0.5))),
        "plain_words": let(part(r"(?<!\S)[\p{L}\p{M}'’-]+[.,;:?!]?(?!\S)"), lambda x: both(x < 0.7, x > 0.85)),
    }


#: What a labeller is taken to say of a good and of a bad text before anything is known: nothing, bad, good.
GOOD_SAYS = (0.39, 0.01, 0.6)
BAD_SAYS = (0.5, 0.3, 0.2)


@dataclass
class LabelModel:
    """The prior of good, and how often each labeller says nothing, bad or good of texts of each class. Silence counts as
    an answer, so that a labeller that only ever looks for one fault has an accuracy too."""

    names: list[str]
    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        each = np.arange(votes.shape[1])
        g = np.log(self.prior) + np.log(self.good[each, votes + 1]).sum(1)
        b = np.log1p(-self.prior) + np.log(self.bad[each, votes + 1]).sum(1)
        return 1 / (1 + np.exp(np.clip(b - g, -500, 500)))


def fit_labels(names: list[str], votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents show each. What is assumed beforehand weighs as
    much as one document."""
    start = lambda says: np.tile(np.array(says), (len(names), 1))
    model = LabelModel(names, 0.8, start(GOOD_SAYS), start(BAD_SAYS))
    for _ in range(rounds):
        p = model.posterior(votes)
        said = lambda weight, says: (np.stack([((votes == v) * weight[:, None]).sum(0) for v in (-1, 0, 1)], 1) + np.array(says)) / (weight.sum() + 1)
        before = model
        model = LabelModel(names, float(np.clip((p * counts).sum() / max(1e-9, counts.sum()), 0.02, 0.98)), said(p * counts, GOOD_SAYS), said((1 - p) * counts, BAD_SAYS))
        if abs(before.prior - model.prior) < 1e-9:
            break
    return model


_LETTERS = [(re.compile(r"[^\W\d_]*[a-zß-öø-ÿ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_a]{2,}"), "AA"), (re.compile(r"\d+"), "0")]
_MANY = re.compile(r"(.)\1{2,}")
_MARKS = frozenset(".,;:?!")


def shape(word: str) -> str:
    """A word's form: runs of letters as a (or AA for capitals only), digits as 0, marks as they are, two of each at most;
    the first twelve characters of that. Words of letters and one mark at most need no expression."""
    body, mark = (word[:-1], word[-1]) if word[-1:] in _MARKS else (word, "")
    if body.isalpha() and body.isascii():
        return ("a" if not body.isupper() else "AA" if len(body) > 1 else body) + mark
    for pattern, to in _LETTERS:
        word = pattern.sub(to, word)
    return _MANY.sub(r"\1\1", word)[:12]


class Shapes(dict):
    """A number for each word and, in slots, the hashed feature of its shape; starts anew when it has grown large."""

    def __init__(self):
        super().__init__()
        self.slots = np.zeros(4096, np.int64)
        self.known: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        import xxhash

        n = self[word] = len(self)
        if n == len(self.slots):
            self.slots = np.concatenate([self.slots, np.zeros_like(self.slots)])
        form = shape(word)
        slot = self.known.get(form)
        if slot is None:
            slot = self.known[form] = 2 + xxhash.xxh32_intdigest(form) % (DIMENSIONS - 2)
        self.slots[n] = slot
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
            self.known.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def variety(ids: np.ndarray) -> float:
    """The share of words (by number) that their stretch of the text has not had before or, where that is less, of
    passages that the whole text has not had before; so neither hangs on the text's length."""
    n = len(ids)
    new = len(np.unique(ids + (np.arange(n) // STRETCH << 32))) / n
    if n < PASSAGE:
        return new
    h = np.zeros(n - PASSAGE + 1, np.uint64)
    for k in range(PASSAGE):
        h = (h ^ ids[k : n - PASSAGE + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return min(new, len(np.unique(h)) / len(h))


def features(text: str, shapes: Shapes) -> np.ndarray:
    """Shares of the text's words by hashed shape; in front the share equal to the word before and the share of words
    or passages that the text has already had, above what prose shows."""
    words = text.split()
    out = np.zeros(DIMENSIONS, np.float32)
    if words:
        n = len(words)
        ids = shapes.numbers(words)
        out[:] = np.sqrt(np.bincount(shapes.slots[ids], minlength=DIMENSIONS) / n)
        out[0] = (ids[1:] == ids[:-1]).sum() / n
        out[1] = max(0.0, 0.6 - variety(ids))
    return out


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str, shapes: Shapes) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(text, shapes) @ self.weights + self.bias, -30, 30))))


def fit_scorer(texts: list[str], targets: np.ndarray, rounds: int = 400, rate: float = 4.0, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by full gradient steps; both classes weigh the same."""
    shapes = Shapes()
    if not texts:
        return Scorer(np.zeros(DIMENSIONS, np.float32), 4.0)
    x = np.stack([features(t, shapes) for t in texts])
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    bad = max(float((1 - targets).sum()), 1.0)
    weight = np.where(targets < 0.5, max(1.0, targets.sum() / bad), 1.0)
    weight /= weight.sum()
    w, b = np.zeros(x.shape[1]), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = (p - targets) * weight
        w -= rate * (x.T @ g + decay * w)
        b -= rate * g.sum()
    out = np.zeros(DIMENSIONS, np.float32)
    out[used] = w
    return Scorer(out, float(b))


def sample_of(docs: DataFrame, rows: int, tables: Tables) -> DataFrame:
    """(text) of so many distinct texts of all of docs at most, those with the smallest hashes, stored. Hashes alone are
    compared, so each text has the same chance wherever it stands and however many copies it has, and reruns agree."""
    texts = docs.select(text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    chosen = texts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).orderBy("h").limit(rows).select(F.col("h").alias("of"))
    found = texts.join(F.broadcast(chosen), F.col("h") == F.col("of"), "left_semi")
    return tables.put(found.groupBy("h").agg(F.min("text").alias("text")).select("text"))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[LabelModel, Scorer]:
    """Votes are counted over all documents; the scorer learns from at most sample_rows distinct texts out of all."""
    votes = labellers()
    names = list(votes)
    as_votes = lambda df: df.withColumn("words", words_of(F.col("text"))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).select("text", *[v.alias(k) for k, v in votes.items()])
    patterns = as_votes(docs.select(text_of().alias("text"))).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    table = np.array([[r[k] for k in names] for r in patterns], np.int64).reshape(-1, len(names))
    counts = np.array([r["n"] for r in patterns], np.float64)
    model = fit_labels(names, table, counts)
    got = as_votes(sample_of(docs, sample_rows, Tables(docs.sparkSession, "quality"))).orderBy("text").collect()
    targets = model.posterior(np.array([[r[k] for k in names] for r in got], np.int64).reshape(-1, len(names))) if got else np.empty(0)
    return model, fit_scorer([r["text"] for r in got], targets)


def _score(scorer):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = scorer.value
        shapes = own.__dict__.setdefault("shapes", Shapes())  # for the batches of a worker
        return pa.array([own.score(t or "", shapes) for t in texts.to_pylist()], pa.float64())

    return score


def score_column(docs: DataFrame) -> Column:
    small_batches(docs.sparkSession)
    _, scorer = train(docs)
    return _score(docs.sparkSession.sparkContext.broadcast(scorer))(text_of())


def classify(docs: DataFrame) -> DataFrame:
    """(doc_id, score, kept): a row per document."""
    return docs.select("doc_id", score_column(docs).alias("score")).select("doc_id", "score", (F.col("score") >= GOOD).alias("kept"))


def filter_good(docs: DataFrame) -> DataFrame:
    """Rows of docs that the scorer takes for good."""
    score = free_name(docs, "score")
    return docs.withColumn(score, score_column(docs)).where(F.col(score) >= GOOD).drop(score)
