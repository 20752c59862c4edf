"""Operator 10: n-gram Jaccard join with prefixes of token combinations.

A document's tokens are its distinct word shingles. All sets share one order of tokens: light ones first, then heavy
ones (those that many prefixes hold), each by hash. Two sets that are similar enough differ in few tokens, so short
prefixes of both must meet: in three light tokens (the prefix is extended by two for that), or, where a set has too few
light tokens and its prefix reaches into the heavy ones, in a combination of two tokens of one class of heavy tokens.
Only pairs that meet so are compared, and every one is verified on whole sets.

Equal sets are one node from the start. Signatures that few sets share give pairs. Sets that share a signature with
many others form clusters. Each set of a cluster is compared with the cluster's first set, its representative: those
similar to it are linked by that and never compared with each other. As the Jaccard distance is a metric, two sets can
be similar only if their distances from the representative differ by no more than similar sets do. So the rest is dealt
into rings by that distance, and only sets of a ring and the next one are compared, block by block, so that no task
holds a whole ring and no row is made for a pair that isn't a link.

Sets are named by numbers of their own, never by ids of documents, so that rows are judged by their own text whatever
their ids. A set's tokens are read again from the rows of its smallest id (from those without an id, if all lack one).

Defined results: null and empty texts have the empty set and are linked with nothing, their component is their own id; a
text shorter than the width is one token; rows with equal ids keep rows of their own, judged by their own text; a row
without an id has the smallest id that its links reach, null if there is none; an empty table gives an empty result;
extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, free_name, small_batches, text_of
from .components import components

#: A signature that more sets share is handled by blocks. A token that more windows hold is heavy.
FEW = 64
HEAVY = 32
#: Heavy tokens are sent to all tasks: at most so many, the most frequent ones (8 bytes each).
MAX_HEAVY = 1_000_000
#: Light tokens that the prefixes of two similar sets have in common at least, if they share no combination.
LIGHT = 3
#: Heavy tokens in one class, about, and sets in one block.
CLASS_SIZE = 8
BLOCK = 256
#: Ids up to so many are broadcast (8 bytes each), more are joined.
BROADCAST_IDS = 500_000

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_S = np.uint64(29)


def mark_of(text) -> Column:
    """A digest of a whole text, 16 bytes."""
    return F.unhex(F.md5(text))


class _Words(dict):
    """64-bit hashes of words; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, width: int, words: _Words) -> np.ndarray:
    """The set of a text: hashes of its distinct shingles in ascending order."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    k = min(width, len(h))
    n = len(h) - k + 1
    out = np.full(n, 0 if k == width else k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * _M[0]
        out ^= out >> _S
    return np.unique(out)


def missing(n: int, percent: int) -> int:
    """How many tokens of a set of n a similar set may lack."""
    return n - -(-percent * n // 100)


def _window(n: int, percent: int) -> int:
    return n if n <= 64 else min(n, max(64, 3 * (missing(n, percent) + LIGHT) // 2))


def _bands(percent: int) -> np.ndarray:
    """Sizes at which bands begin: similar sets are in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges)


def signatures(tokens: np.ndarray, n: int, heavy: np.ndarray, percent: int, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Light tokens and combinations of heavy ones that a set is indexed by, from its first tokens; None if these don't
    suffice. A similar set lacks at most need - 1 tokens of the prefix, and the prefix has need more than LIGHT - 1 light
    ones and one of each class, so that LIGHT light ones or two of a class are in both."""
    need = missing(n, percent) + 1
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
        is_heavy = heavy[at] == tokens
    else:
        is_heavy = np.zeros(len(tokens), bool)
    light = tokens[~is_heavy]
    if len(light) >= need + LIGHT - 1:
        return light[: need + LIGHT - 1], np.empty(0, np.uint64)
    if len(tokens) < n:
        return None
    dark, out = tokens[is_heavy], [np.empty(0, np.uint64)]
    band = int(np.searchsorted(bands, n, side="right")) - 1
    for b in (band, band + 1):
        classes = max(1, -(-(missing(int(bands[b + 1]) - 1, percent) + 1) // CLASS_SIZE))
        of = (dark * _M[1] >> np.uint64(33)) % np.uint64(classes)
        order = np.argsort(of, kind="stable")
        rank = np.empty(len(dark), np.int64)
        starts = np.searchsorted(of[order], np.arange(classes, dtype=np.uint64))
        rank[order] = np.arange(len(dark)) - starts[of[order].astype(np.int64)]
        enough = np.flatnonzero(max(0, len(light) - LIGHT + 1) + np.cumsum(rank > 0) >= need)
        end = enough[0] + 1 if len(enough) else len(dark)
        for c in range(classes):
            mine = dark[:end][of[:end] == c]
            i, j = np.triu_indices(len(mine), 1)
            pair = (mine[i] * _M[0] ^ (mine[j] >> _S) ^ mine[j]) * _M[1] + np.uint64(b)
            out.append((pair ^ (pair >> _S)) * _M[0])
    return light, np.concatenate(out)


def _arrays(batch: pa.RecordBatch, *names: str):
    return [batch.column(name).to_pylist() for name in names]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _first_tokens(width: int, percent: int):
    def run(batches):
        words = _Words()
        for batch in batches:
            sets = [shingles(t, width, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(map(len, sets), pa.int64()), pa.array(map(_key, sets), pa.binary()), _lists([s[: _window(len(s), percent)] for s in sets])], ["doc_id", "mark", "n", "key", "win"])

    return run


def _sets(width: int):
    def run(batches):
        words = _Words()
        for batch in batches:
            sets = [shingles(t, width, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(map(_key, sets), pa.binary()), pa.array(map(len, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "n", "tokens"])

    return run


def _signature_rows(heavy, percent: int, whole: bool):
    def run(batches):
        bands, known = _bands(percent), heavy.value
        for batch in batches:
            ids, sizes = _arrays(batch, "id", "n")
            column = batch.column("tokens")
            made = []
            for i, n in enumerate(sizes):
                tokens = np.frombuffer(column[i].as_py(), np.uint64) if whole else column[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                made.append(signatures(tokens, n, known, percent, bands))
            none = (np.zeros(1, np.uint64), np.empty(0, np.uint64))
            parts = [none if s is None else s for s in made]
            lengths = [len(x) + len(y) for x, y in parts]
            empty = [np.empty(0, np.uint64)]
            sig = np.concatenate([z for x, y in parts for z in (x, y)] + empty)
            light = np.concatenate([np.full(len(z), is_light) for x, y in parts for z, is_light in ((x, True), (y, False))] + [np.empty(0, bool)])
            done = np.repeat(np.array([s is not None for s in made], bool), lengths)
            columns = [pa.array(sig.view(np.int64), pa.int64()), pa.array(np.repeat(np.array(ids, np.int64), lengths), pa.int64()), pa.array(np.repeat(np.array(sizes, np.int64), lengths), pa.int64()), pa.array(light, pa.bool_()), pa.array(done, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["sig", "id", "n", "light", "done"])

    return run


def _similar(percent: int):
    """Pairs of sets (a, x, b, y) that are similar enough."""

    def run(batches):
        for batch in batches:
            xs, ys = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(xs[i].as_py(), np.uint64), np.frombuffer(ys[i].as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def block_links(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets of the left block and the others (within the left block where there are no others), less
    those that follow from links already found."""
    right = np.flatnonzero(~left) if (~left).any() else np.flatnonzero(left)
    same = not (~left).any()
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(right, sizes[right])
    tokens = np.concatenate([sets[i] for i in right])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    root = np.arange(len(sets))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in np.flatnonzero(left):
        lo, hi = np.searchsorted(tokens, sets[i]), np.searchsorted(tokens, sets[i], side="right")
        count = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        both = np.bincount(owners[at], minlength=len(sets))
        linked = 100 * both >= percent * (sizes[i] + sizes - both)
        for j in np.flatnonzero(linked & (both > 0)):
            if (not same or j > i) and j != i and ids[i] != ids[j] and find(i) != find(j):
                root[find(i)] = find(j)
                out.append((int(ids[i]), int(ids[j])))
    return out


def _rings(percent: int):
    """(root, node, ring, linked): how far each set is from its cluster's representative, in distances within which sets
    are similar, rounded down, and whether both are similar."""

    def run(batches):
        for batch in batches:
            xs, ys = batch.column("tokens"), batch.column("pivot")
            rings, linked = [], []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(xs[i].as_py(), np.uint64), np.frombuffer(ys[i].as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                rings.append(100 * (union - both) // max(1, (100 - percent) * union))
                linked.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("node"), pa.array(rings, pa.int32()), pa.array(linked, pa.bool_())], ["root", "node", "ring", "linked"])

    return run


def _block_pairs(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(t, np.uint64) for t in pdf["tokens"]]
        left, one = pdf["left"].to_numpy(), bool(pdf["one"].iloc[0])
        links = block_links(pdf["id"].to_numpy(), sets, left, percent) if left.any() and (one or not left.all()) else []
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def cluster_links(clusters: DataFrame, sets: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """(a, b): links that connect all similar sets of each cluster (node, root). sets: (id, tokens)."""
    blocks = lambda n: F.ceil(n / BLOCK)
    sizes = clusters.groupBy("root").agg(blocks(F.count(F.lit(1))).alias("blocks"))
    placed = clusters.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    members = placed.join(sets, placed.node == sets.id)
    pivots = members.where("node = root").select("root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("tokens").alias("pivot"))
    near = members.select("root", "block", "node", "tokens").join(pivots, ["root", "block"]).select("root", "node", "tokens", "pivot")
    near = tables.put(near.mapInArrow(_rings(percent), "root long, node long, ring int, linked boolean"))

    # cells: rings from 1 on of sets that aren't linked, -1 and -2 of linked ones in ring 0 and (just at the limit) ring 1
    rows = near.select("root", "node", F.when(F.col("linked"), -1 - F.col("ring")).otherwise(F.col("ring")).alias("cell"))
    cells = tables.put(rows.groupBy("root", "cell").agg(blocks(F.count(F.lit(1))).alias("blocks")))
    a, b = (cells.select("root", F.col("cell").alias(x), F.col("blocks").alias("n" + x)) for x in "ab")
    meet = a.join(b, "root").where("a > 0 and (b in (a, a + 1) or (b = -1 and a = 1) or (b = -2 and a in (1, 2)))")
    meet = tables.put(meet)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    first = rows.join(meet.withColumnRenamed("a", "cell"), ["root", "cell"]).select("root", F.col("cell").alias("a"), "b", "node", mine("na").alias("i"), upto("nb").alias("j"))
    same = F.col("a") == F.col("b")
    first = first.select("root", "a", "b", "node", F.when(same, F.least("i", "j")).otherwise(F.col("i")).alias("p"), F.when(same, F.greatest("i", "j")).otherwise(F.col("j")).alias("q"), (~same | (F.col("i") <= F.col("j"))).alias("left"))
    second = rows.join(meet.where("a <> b").withColumnRenamed("b", "cell"), ["root", "cell"]).select("root", "a", F.col("cell").alias("b"), "node", upto("na").alias("p"), mine("nb").alias("q"), F.lit(False).alias("left"))
    dealt = first.union(second).withColumn("one", same & (F.col("p") == F.col("q")))
    in_blocks = dealt.join(sets, dealt.node == sets.id).select("root", "a", "b", "p", "q", "one", "left", "id", "tokens")
    found = in_blocks.groupBy("root", "a", "b", "p", "q").applyInPandas(_block_pairs(percent), "a long, b long")
    return near.where("linked and node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(found)


def _sets_of(texts: DataFrame, wanted: DataFrame, width: int, repeats: bool) -> DataFrame:
    """(id, n, tokens) of the sets wanted (id, doc, key). repeats: whether ids of documents are repeated or null."""
    per = wanted.agg(F.count(F.lit(1)).alias("n"), F.count("doc").alias("docs")).first()
    send = F.broadcast if per["n"] <= BROADCAST_IDS else (lambda df: df)
    docs = send(wanted.where("doc is not null").select("doc").distinct())
    rows = texts.join(docs, texts.doc_id == docs.doc, "left_semi")
    if per["docs"] < per["n"]:
        rows = rows.union(texts.where("doc_id is null"))
    sets = rows.select("text").mapInArrow(_sets(width), "key binary, n long, tokens binary").where("n > 0")
    found = sets.join(send(wanted.select("id", "key")), "key").select("id", "n", "tokens")
    return found.groupBy("id").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")) if repeats else found


def _joined(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, mark, n, root, component, links): a row per document. mark: a digest of its text; root: the number of its
    component, null for the empty set; component: the smallest id in it."""
    spark = docs.sparkSession
    small_batches(spark)
    tables = Tables(spark, "ngrams")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    marked = texts.withColumn("mark", mark_of("text"))
    first = tables.put(marked.mapInArrow(_first_tokens(width, percent), "doc_id long, mark binary, n long, key binary, win array<long>"))
    rows = tables.put(first.select("doc_id", "mark", "n", "key"))
    repeats = not rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()
    sets_ = first.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("win").alias("tokens"))
    nodes = tables.put(sets_.withColumn("id", F.monotonically_increasing_id()))
    names = tables.put(nodes.select("id", "doc", "key"))
    tables.drop(first)

    counts = nodes.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    frequent = tables.put(counts.where(F.col("c") > HEAVY))
    limit, n = HEAVY, frequent.count()
    while n > MAX_HEAVY:
        limit *= 2
        n = frequent.where(F.col("c") > limit).count()
    found = [r["token"] for r in frequent.where(F.col("c") > limit).select("token").toLocalIterator()]
    heavy = spark.sparkContext.broadcast(np.sort(np.array(found, np.int64).view(np.uint64)))

    shape = "sig long, id long, n long, light boolean, done boolean"
    short = nodes.select("id", "n", "tokens").mapInArrow(_signature_rows(heavy, percent, False), shape)
    made = tables.put(short)
    deep = tables.put(names.join(made.where("not done").select("id").distinct(), "id", "left_semi"))
    more = _sets_of(texts, deep, width, repeats).mapInArrow(_signature_rows(heavy, percent, True), shape).select("sig", "id", "n", "light")
    every = made.where("done").select("sig", "id", "n", "light").union(more)
    per = Window.partitionBy("sig")
    shared = tables.put(every.withColumns({"c": F.count(F.lit(1)).over(per), "pivot": F.min("id").over(per)}).where("c > 1"))
    tables.drop(made, nodes)

    lists = shared.where(F.col("c") <= FEW).groupBy("sig").agg(F.sort_array(F.collect_set(F.struct("id", "n"))).alias("l"), F.max(F.when(F.col("light"), 1).otherwise(LIGHT)).alias("worth"))
    lists = lists.groupBy("l").agg(F.sum("worth").alias("worth"))
    close = lambda x, y: F.struct(x["id"].alias("a"), y["id"].alias("b"), (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])).alias("ok"))
    every_pair = F.flatten(F.transform("l", lambda x, i: F.filter(F.transform(F.slice("l", i + 2, F.size("l")), lambda y: close(x, y)), lambda p: p["ok"])))
    pairs = tables.put(lists.select("worth", F.explode(every_pair).alias("p")).where("p.a <> p.b").groupBy("p.a", "p.b").agg(F.sum("worth").alias("worth")).where(F.col("worth") >= LIGHT).select("a", "b"))
    many = shared.where(F.col("c") > FEW).select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    clusters = tables.put(components(many, tables))

    linked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(clusters.select("node")).distinct()
    asked = tables.put(names.join(linked, "id", "left_semi"))
    sets = tables.put(_sets_of(texts, asked, width, repeats))
    with_x = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
    with_y = with_x.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    links = with_y.select("a", "x", "b", "y").mapInArrow(_similar(percent), "a long, b long")

    found_links = tables.put(links.union(cluster_links(clusters, sets, percent, tables)))
    tables.drop(shared, pairs, asked, sets)

    roots = tables.put(components(found_links, tables))
    degree = found_links.select(F.col("a").alias("node")).union(found_links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    members = roots.join(names.select(F.col("id").alias("node"), "doc"), "node")
    members = members.join(members.groupBy("root").agg(F.min("doc").alias("component")), "root").join(degree, "node", "left")
    named = names.join(members.select(F.col("node").alias("id"), "root", "component", "links"), "id", "left")
    named = named.select("key", F.coalesce("root", "id").alias("root"), F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return rows.join(named, "key", "left")


def join_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, links): a row per document. component_id is the smallest id that links reach;
    links counts the representative's links to other sets that were needed to connect it."""
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return _joined(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))


def keep_one(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of docs, all columns: of each component the row of the smallest id (without an id if all are), and of several
    rows of that id the one whose text's digest is the smallest. Documents without words all stay."""
    tables = Tables(docs.sparkSession, "kept")
    rows = tables.put(_joined(docs, width, percent).select("doc_id", "mark", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("m")
    kept = rows.where("root is not null").groupBy("root").agg(first).select("m.doc_id", "m.mark")
    kept = tables.put(kept.union(rows.where("root is null").select("doc_id", "mark").distinct()))
    send = F.broadcast if kept.count() <= BROADCAST_IDS else (lambda df: df)
    place, mark = free_name(docs, "place"), free_name(docs, "mark")
    at = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"))
    marked = docs.withColumns({place: at, mark: mark_of(text_of())})

    def among(df: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
        wanted = send(wanted.select(at.alias("p"), F.col("mark").alias("m")))
        return df.join(wanted, (df[place] == wanted["p"]) & (df[mark] == wanted["m"]), how)

    out = among(marked, kept, "left_semi")
    twice = rows.where("root is not null").groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark")
    twice = tables.put(twice.join(kept, twice.doc_id.eqNullSafe(kept.doc_id) & (twice.mark == kept.mark), "left_semi"))
    if not twice.isEmpty():
        out = among(out, twice, "left_anti").unionByName(among(out, twice, "left_semi").dropDuplicates([place, mark]))
    return out.select(*docs.columns)
