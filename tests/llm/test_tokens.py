"""Encoding, decoding and aligning by the public vocabularies, held against their own libraries."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from concord.llm import byte_bpe, cross_tokens, queries

SF = "/root/testdata/sf0.001"
RANKS = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, P.PATTERN)


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


ODD = [None, "", " ", "  ", "\n", "a", "\x1c \x85　 x", "<|endoftext|>", "it's they'Re '", "日本語" * 50, "aab" * 400, "=-" * 900 + "x", "ab  cd\n\n ef", "naïve ÅÉ ½ ١٢٣", "\U0001f600‍️"]


def test_odd_texts_and_rows(spark, library):
    rows = [(None if i == 3 else i // 2, t, "x", "y") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")
    out = byte_bpe.digests(docs, RANKS, P.PATTERN).collect()
    want = [(r[0], *expected(library, r[1])) for r in rows]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert byte_bpe.digests(docs.limit(0), RANKS, P.PATTERN).collect() == []


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op13_byte_bpe(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == {i: expected(library, t) for i, t in texts.items()}


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(encoder, library, text):
    ids = encoder.encode([text])[0]
    assert ids == packed(library.encode_ordinary(text)) and encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("alphabet", ["ab", "aab=", "abcdefghijklmnopqrstuvwxyz", "éèà中", "0123456789", " \n\tx", "'srevlldtm "])
def test_long_matches_and_pieces(encoder, library, alphabet, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE", 100)
    random.seed(alphabet)
    texts = ["".join(random.choices(alphabet, k=n)) for n in (250, 256, 257, 300, 900, 4000)]
    assert encoder.encode(texts) == [packed(library.encode_ordinary(t)) for t in texts]


def test_a_lower_rank_after_a_merge_comes_first():
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"aba", b"ab", b"ca"]
    ranks = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    own = byte_bpe.Encoder(ranks, r"\w+")
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=own.ids, special_tokens={})
    random.seed(1)
    for n in (3, 10, 100, 300, 2000):
        text = "".join(random.choices("abc", k=n))
        assert own.encode([text])[0] == packed(library.encode_ordinary(text))


def test_a_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="bytes without a token"):
        byte_bpe.Encoder(b"YQ== 0", r"\w+")


MODELS = cross_tokens.read_models(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def sides():
    a, b = Tokenizer.from_buffer(MODELS[0]), sentencepiece.SentencePieceProcessor(model_proto=MODELS[1])
    a.encode_special_tokens = True
    return a, b


def plain_tokens(sides, text):
    """(id, begin, end) of whole texts by the libraries; None if a side doesn't give the text back."""
    if not text:
        return None
    a, b = sides
    of = cross_tokens.byte_of_character()
    i, j = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    names = [b.id_to_piece(t) for t in j]
    raw = [[bytes(of[c] for c in a.id_to_token(t)) for t in i], [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode() for t, p in zip(j, names)]]
    if any(b"".join(x) != (" " + text).encode() for x in raw):
        return None
    out = []
    for ids, parts in zip((i, j), raw):
        at, side = 0, []
        for t, p in zip(ids, parts):
            side.append((t, at, at + len(p)))
            at += len(p)
        out.append(side)
    return out


def plain_alignment(sides, rows):
    """What align() returns with groups as text, from whole texts."""
    found = [(i, plain_tokens(sides, t)) for i, t in rows]
    linked, texts = [], []
    for _, tokens in found:
        if not tokens:
            linked.append([])
            texts.append(("", 0))
            continue
        a, b = tokens
        linked.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 600 else swept(a, b))
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= e) for side in (a, b)) if len(a) < 600 else (lo, e))
            lo = e
        texts.append((";".join(groups), len(ends)) if len(a) < 600 else (grouped(a, b, ends), len(ends)))
    counts = {}
    for pairs in linked:
        for p in set(pairs):
            counts[p] = counts.get(p, 0) + 1
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return sorted([(i, len(t[0]) if t else 0, len(t[1]) if t else 0, n, len(pairs), sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs), text) for (i, t), pairs, (text, n) in zip(found, linked, texts)], key=str)


def swept(a, b):
    out, y = [], 0
    for t, lo, hi in a:
        while b[y][2] <= lo:
            y += 1
        k = y
        while k < len(b) and b[k][1] < hi:
            out.append((t, b[k][0]))
            k += 1
    return out


def grouped(a, b, ends):
    place = {e: k for k, e in enumerate(ends)}
    parts = []
    for side in (a, b):
        groups = [[] for _ in ends]
        k = 0
        for t, _, hi in side:
            groups[k].append(str(t))
            k = place[hi] + 1 if hi in place else k
        parts.append([",".join(g) for g in groups])
    return ";".join(map("|".join, zip(*parts)))


@pytest.mark.parametrize("chunk", [1 << 16, 7, 300])
def test_alignment_of_odd_rows(spark, sides, chunk):
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate([*ODD, "▁ marks ▁▁x", "plain words of prose, twice over: plain words of prose", "plain words of prose, twice over: plain words of prose", "\0 nul", "ﬁ ligature ½ " * 40, "x" * 3000])]
    docs = spark.createDataFrame([(*r, "p", "q") for r in rows], "doc_id long, text string, key string, pairs string")
    out = cross_tokens.align(docs, *MODELS, chunk=chunk)
    assert sorted(map(tuple, out.collect()), key=str) == plain_alignment(sides, rows)
    assert cross_tokens.align(docs.limit(0), *MODELS).collect() == []


def test_alignment_by_slices_of_counts(spark, sides, monkeypatch):
    monkeypatch.setattr(cross_tokens, "SLICE", 40)
    rows = [(i, f"some words {'and more ' * (i % 3)}of text {i}") for i in range(30)]
    out = cross_tokens.align(spark.createDataFrame(rows, "doc_id long, text string"), *MODELS)
    assert sorted(map(tuple, out.collect()), key=str) == plain_alignment(sides, rows)


def test_alignment_query_equals_whole_texts(spark, sides):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_alignment(sides, rows)]
    assert sorted(map(tuple, queries.op12_cross_tokenizer_alignment(spark, SF).collect()), key=str) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(exclude_characters="▁\0", exclude_categories=["Cs"]), min_size=1, max_size=60), st.lists(st.integers(1, 60), max_size=6), st.randoms())
def test_fragments_compose_in_any_tree(text, at, rand):
    tokens = cross_tokens._aligner(*MODELS).tokens(text, 0)
    if tokens is None:
        return
    edges = [0, *sorted(set(at)), 1 << 30]
    found = [cross_tokens.fragment(tokens.between(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    closed = [(c.a[0, 1], c.spelled()) for _, c in found if len(c.a)]
    parts = [f for f, _ in found]
    while len(parts) > 1:
        i = rand.randrange(len(parts) - 1)
        parts[i : i + 2] = [cross_tokens.compose(parts[i], parts[i + 1])]
    whole = cross_tokens.compose(cross_tokens.EMPTY, parts[0])
    groups = sorted(closed + [(j.a[0, 1], j.spelled()) for j in (*whole.joints, whole.tail)])
    assert not len(whole.head.a) and ";".join(g for _, g in groups) == tokens.spelled()
