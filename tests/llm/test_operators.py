"""Nulls, empty and long texts, repeated rows, empty tables, extra columns; brute force where SQL says nothing."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from concord.llm import chat_format, decontaminate, licenses, line_dedup, mixing, ngram_join, quality_rules, toxicity, url_filter, weak_quality

#: With extra columns named like those that operators use within.
EXTRA = ("words", "norm", "host", "host_", "bad_", "lines_", "kept_", "n_lines", "hashes", "hash", "key", "leaks", "text_key", "copies", "cut", "score", "label", "id", "at")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
PROSE = " ".join(f"word{i % 37} of prose{i} stands." for i in range(40))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, *["x"] * len(EXTRA)) for i, t, s in rows], DOCS)


ODD = [(1, None, None), (2, "", "a"), (3, PROSE, "a"), (3, PROSE, "a"), (4, "long words here " * 20000, None), (5, " \n\t ", "b"), (None, "no id", "b"), (6, "x", "b")]
LABELS = "doc_id long, quality int, toxic int"


def runs(spark):
    labels = lambda: spark.createDataFrame([(3, 1, 0), (4, None, None), (None, 0, 1)], LABELS)
    bench = lambda: spark.createDataFrame([(1, PROSE[:200]), (2, None), (3, "")], "item_id long, text string")
    return {
        "1": weak_quality.classify,
        "2": licenses.scan,
        "3": quality_rules.judge,
        "4": lambda d: toxicity.score(d, labels()),
        "6": lambda d: decontaminate.report(d, bench()),
        "8": line_dedup.drop_boilerplate,
        "9": mixing.mix,
        "10": ngram_join.join_components,
        "pipeline 1": weak_quality.filter_good,
        "pipeline 6": lambda d: decontaminate.filter_clean(d, bench()).unionByName(d.limit(0)),
        "pipeline 9": lambda d: mixing.mix_rows(d),
    }


@pytest.mark.parametrize("op", ["pipeline 1", "pipeline 6", "pipeline 9"])
def test_filters_keep_columns_of_odd_rows(spark, op):
    run, rows = runs(spark)[op], docs(spark, ODD)
    out = run(rows)
    assert set(rows.columns) <= set(out.columns) and out.count() <= 3 * len(ODD)
    assert run(docs(spark, [])).collect() == []


def test_odd_conversations(spark):
    """Long and repeated turns, nulls in every column, extra columns named like those within."""
    shape = "conv_id long, turn long, role string, text string, turns string, give string, at long, chosen string"
    rows = [(1, 0, "user", "long " * 100000), (1, 1, "assistant", "long " * 100000), (1, 1, "assistant", "long " * 100000), (2, 0, "user", "q"), (2, None, "assistant", "a"), (3, 0, None, None), (None, None, None, None), (None, 1, "assistant", "n")]
    run = lambda x: chat_format.format_preferences(chat_format.with_rejected(chat_format.conversations(spark.createDataFrame([(*r, "x", "x", 9, "x") for r in x], shape)))).collect()
    got = {r["conv_id"]: r for r in run(rows)}
    assert set(got) == {1, 2, 3, None} and got[3]["status"] == "no_reply" and got[None]["n_common"] is not None
    assert got[1]["donor_id"] == 2 and got[1]["prompt"].count("<|end|>") == 2 and got[1]["rejected"] == "<|assistant|>\na<|end|>\n" or got[1]["n_common"] >= 1
    assert run([]) == []


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "http://" + "a." * 2000 + "com/en/" + "x" * 100000), (4, "://"), (5, "http:///en/"), (5, "http:///en/"), (None, "http://COM/en/"), (6, "x://a.net/de/?q#f"), (7, "http://..com/en/")]
    df = spark.createDataFrame([(*r, "h", "r", "k", "f") for r in rows], "page_id long, url string, host string, rule string, keys string, found string")
    got = sorted(((r["page_id"] or 0, r["rule"], r["verdict"]) for r in url_filter.judge(df).collect()), key=str)
    assert got == sorted([(1, None, "allow"), (2, None, "allow"), (3, "com/en/", "block"), (4, None, "allow"), (5, None, "allow"), (5, None, "allow"), (0, "com/en/", "block"), (6, "net/de/", "block"), (7, "com/en/", "block")], key=str)
    assert url_filter.judge(df.limit(0)).collect() == []


@pytest.mark.parametrize("bits,n", [(1 << 23, 100_000), (1 << 15, 6_000)])
def test_long_lists(spark, monkeypatch, bits, n):
    """A list of a hundred thousand hosts, and one far beyond the bits of a part: exact for every page."""
    monkeypatch.setattr(url_filter, "MAX_BITS", bits)
    hosts = spark.range(n).select(F.concat(F.lit("h"), (F.col("id") * 3).cast("string"), F.lit(".example.com")).alias("host"))
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), F.col("id").cast("string"), F.lit(".example.com"), F.when(F.col("id") % 5 == 0, "/en/7").otherwise("/fr/")).alias("url"))
    out = url_filter.judge(pages, hosts=hosts).collect()
    assert len(out) == 20_000
    for r in out:
        i = r["page_id"]
        assert (r["rule"], r["verdict"]) == (("example.com/en/7", "allow") if i % 5 == 0 else (None, "block" if i % 3 == 0 and i < 3 * n else "allow"))


def test_listed_hosts(spark):
    got = [r["host"] for r in url_filter.listed_hosts(spark).collect()]
    assert len(got) == len(set(got)) == 2184 and "spam-farm.example.com" in got


@pytest.mark.parametrize("op", ["1", "2", "3", "4", "6", "8", "9", "10"])
def test_odd_rows_and_empty_tables(spark, op):
    run = runs(spark)[op]
    assert len(run(docs(spark, ODD)).collect()) == len(ODD)
    assert run(docs(spark, [])).collect() == []


def test_licenses(spark):
    text = "See the GNU General Public License, and the CC-BY. Apache License 2.0"
    r = licenses.scan(docs(spark, [(1, text, None)])).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (14, 3, 2, 10, "apache,cc-by,gpl")
    spans = [(d["start"], d["stop"], d["priority"]) for d in r["detections"]]
    assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] for a in spans for b in spans)


def test_licenses_against_brute_force(spark):
    """Every rule tried on every whole text, without keywords; places of phrases by comparing words one by one."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rules = [(re.compile(r.pattern, re.ASCII), r) for r in licenses.default_rules()]
    texts = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in licenses.scan(table).collect()}
    assert got.keys() == texts.keys() and any(r["n_base"] for r in got.values())
    for i, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        places = [(at, label) for phrase, label in licenses.BASE for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()]
        norm = " " + " ".join(words) + " "
        spans = sorted((m.start(), -m.end(), r.priority, r.label) for pattern, r in rules for m in pattern.finditer(norm))
        found = {s[3] for n, s in enumerate(spans) if not any(t[1] <= s[1] and t[2] <= s[2] for t in spans[:n])}
        base = {label for _, label in places}
        starts = [at for at, _ in places] or [None]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts), max(starts))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(base)), ",".join(sorted(base | found)))


SPDX = {
    "gpl": "GPL-2.0-only", "lgpl": "LGPL-2.1-or-later", "agpl": "AGPL-3.0-only", "gfdl": "GFDL-1.3-only", "apache": "Apache-2.0", "mit": "MIT", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause",
    "bsd-4-clause": "BSD-4-Clause", "0bsd": "0BSD", "isc": "ISC", "mpl": "MPL-2.0", "epl": "EPL-2.0", "cddl": "CDDL-1.0", "cpl": "CPL-1.0", "cc-by-sa": "CC-BY-SA-4.0", "cc-by-nd": "CC-BY-ND-4.0", "cc-by-nc": "CC-BY-NC-4.0",
    "cc-by-nc-sa": "CC-BY-NC-SA-4.0", "cc-by-nc-nd": "CC-BY-NC-ND-4.0", "cc0": "CC0-1.0", "unlicense": "Unlicense", "wtfpl": "WTFPL", "zlib": "Zlib", "boost": "BSL-1.0", "artistic": "Artistic-2.0", "python": "Python-2.0", "php": "PHP-3.01",
    "ruby": "Ruby", "openssl": "OpenSSL", "w3c": "W3C", "ofl": "OFL-1.1", "odbl": "ODbL-1.0", "odc-by": "ODC-By-1.0", "eupl": "EUPL-1.2", "ms-pl": "MS-PL", "ms-rl": "MS-RL", "postgresql": "PostgreSQL", "ncsa": "NCSA", "afl": "AFL-3.0",
    "osl": "OSL-3.0", "qpl": "QPL-1.0", "ipl": "IPL-1.0", "vim": "Vim", "beerware": "Beerware",
}


def test_license_ids_grants_and_bodies(spark):
    """Each SPDX id alone and as a later operand, each grant by id, and the sentence of each body."""
    texts = [(label, f"// SPDX-License-Identifier: {name}\n") for label, name in SPDX.items()]
    texts += [(label, f"SPDX-License-Identifier: (MIT OR {name})") for label, name in SPDX.items()]
    texts += [(label, f"It is licensed under the {SPDX.get(label, 'BSD')}.") for label in licenses.IDS]
    plain = lambda body: re.sub(r"\(\?![^)]*\)", "", re.sub(r"\(\?:\[\^ \]\+ \)\{1,20\}", "the holder ", body.split("|neither")[0])).replace("[^ ]+", "thing").replace("[sc]", "s")
    plain_all = lambda body: re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", plain(body)).replace(" ?", " ").replace("names?", "name").replace("acknowledge?", "acknowledge")
    texts += [(label, "So: " + plain_all(body).capitalize() + ".") for label, body, _ in licenses.BODIES]
    texts += [("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"), ("apache", "Released under Apache-2.0.")]
    got = {r["doc_id"]: r for r in licenses.scan(docs(spark, [(i, t, None) for i, (_, t) in enumerate(texts)])).collect()}
    for i, (label, text) in enumerate(texts):
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.9, (label, text, got[i])
    for i, label in enumerate(SPDX):
        base = lambda r: {*r["base_labels"].split(",")} - {""}
        assert {*got[i]["labels"].split(",")} == {label, *base(got[i])} and got[i]["score"] == 1.0
        assert {*got[len(SPDX) + i]["labels"].split(",")} == {"mit", label, *base(got[len(SPDX) + i])}
    four = licenses.scan(docs(spark, [(1, "SPDX-License-Identifier: MIT OR Apache-2.0 OR ISC AND GPL-2.0-only WITH Classpath-exception-2.0", None), (2, "Available under Python 3 and under the vim of youth.", None)])).collect()
    assert {r["doc_id"]: r["labels"] for r in four} == {1: "apache,gpl,isc,mit", 2: ""}


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", None), (None, 0, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat_format.format_preferences(chat_format.with_rejected(chat_format.conversations(df))).collect()}
    assert out[1]["chosen"] == "<|assistant|>\nyes<|end|>\n" and out[1]["rejected"] == "<|assistant|>\nno<|end|>\n"
    a, b = map(int, out[1]["chosen_mask"].split("-"))
    assert out[1]["chosen"][a:b] == "yes<|end|>" and out[1]["n_common"] == 1
    assert out[3]["status"] == "no_reply" and len(out) == 4
    assert chat_format.format_preferences(chat_format.with_rejected(chat_format.conversations(df.limit(0)))).count() == 0


def test_urls(spark):
    urls = [(1, "http://a.com/en/1"), (2, "http://x.EXAMPLE.com/en/77?q"), (3, None), (4, "com/en/"), (5, "https://spam-farm.example.org/fr/1"), (6, "http://net/de/"), (6, "http://net/de/"), (7, "http://bcom/en/")]
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = sorted((r["page_id"], r["rule"] or "", r["verdict"]) for r in url_filter.judge(df).collect())
    assert got == [(1, "com/en/", "block"), (2, "example.com/en/7", "allow"), (3, "", "allow"), (4, "", "allow"), (5, "", "block"), (6, "net/de/", "block"), (6, "net/de/", "block"), (7, "", "allow")]
    assert url_filter.judge(df.limit(0)).count() == 0


def test_rules_say_what_the_contract_says(spark):
    """block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/, by rules alone."""
    hosts = ["com", "a.com", "example.com", "net", "a.net", "example.net", "x.example.net", "org", "a.org"]
    paths = ["/en/", "/en/7", "/de/", "/de/8", "/de/81", "/es/", "/"]
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)], "page_id long, url string")
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
    for r in url_filter.judge(df).collect():
        fit = max(((len(h + p), h + p, what) for h, p, what in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)), default=(0, None, "allow"))
        assert (r["rule"], r["verdict"]) == fit[1:], (r["host"], r["path"])


@pytest.mark.parametrize("width,percent,changes", [(3, 90, {}), (5, 80, {"MAX_HEAVY": 20, "BROADCAST_IDS": 1}), (5, 80, {"FEW": 2})])
def test_join_against_brute_force(spark, width, percent, changes, monkeypatch):
    """Clusters of near copies, chains in which ends differ, templates that share a part only; every switch both ways."""
    rng = random.Random(width)
    for name, value in {"HEAVY": 4, "FEW": 6, "BLOCK": 8, **changes}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = []
    chain = [f"c{i}" for i in range(60)]
    for i in range(40):
        rows.append((len(rows), " ".join(chain), None))
        chain[rng.randrange(60)] = f"d{i}"
    for i in range(30):
        rows.append((len(rows), " ".join([f"t{k}" for k in range(40)] + [f"u{i % 9}_{k}" for k in range(rng.choice([4, 5, 20]))]), None))
    for g in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([8, 30, 60, 120]))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = [f"e{rng.randrange(99)}" if rng.random() < 0.008 else w for w in base]
            rows.append((len(rows), " ".join(copy), None))
    sets = {}
    for i, t, _ in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_components(docs(spark, rows), width, percent).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}


def edits(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 8)))
    items = [decontaminate.normalised(" ".join(word() for _ in range(rng.randrange(15, 40)))) for _ in range(6)]
    index = decontaminate.Index(np.arange(6), items, 0.05, decontaminate.Q)
    for n in range(40):
        item = list(items[n % 6])
        for _ in range(rng.randrange(0, 14)):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["z"], ["z", "y"]])
        text = decontaminate.normalised(" ".join([word() for _ in range(20)] + ["".join(item)] + [word() for _ in range(20)]))
        want = {i: edits(p, text) for i, p in enumerate(items)}
        want = {i: e for i, e in want.items() if e <= decontaminate.budget(len(items[i]), 0.05)}
        assert {m[0]: m[1] for m in index.matches(text)} == want


def test_nearest_is_exact():
    """Cosines by hand over all examples, for texts of few and of many words, ties and unknown words."""
    rng = random.Random(3)
    words = [f"{i}word" for i in range(6000)]
    text = lambda n: " ".join(words[min(int(rng.paretovariate(0.3)), len(words)) - 1] for _ in range(n))
    examples = [(i, text(rng.randrange(1, 120)), int(i % 3 == 0)) for i in range(500)]
    examples += [(500 + i, examples[i][1], 1) for i in range(40)] + [(900, "", 0)]
    index = toxicity.fit(examples, 0.3)
    assert len(index.vocabulary) > toxicity.DENSE and len(index.edge) > 10
    by_id = {i: dict(zip(*index.vector(toxicity.terms(t)))) for i, t, _ in examples}
    for query in [text(n) for n in (1, 3, 40, 400)] + [examples[7][1], "nothing known", ""]:
        t, w = index.vector(toxicity.terms(query))
        found, cosines = index.nearest(t, w, toxicity.NEIGHBOURS)
        brute = sorted((sum(x * by_id[int(i)].get(a, 0) for a, x in zip(t, w)) for i in index.ids), reverse=True)[: toxicity.NEIGHBOURS]
        assert np.allclose(cosines, [c for c in brute if c > 0])


def test_toxicity_query_against_brute_force(spark):
    """The whole query on the small table: each document's neighbours from all cosines, votes and predictions from them."""
    from concord.llm import queries

    sf = "/root/testdata/sf0.001"
    docs_, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    examples, prior = toxicity.training(docs_, labels)
    assert len({i for i, _, _ in examples}) == len(examples) and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in examples)
    index = toxicity.fit(examples, prior)
    vectors = [(label, index.vector(toxicity.terms(t))) for _, t, label in examples]
    matrix = np.zeros((len(vectors), len(index.vocabulary)))
    for row, (_, (t, w)) in zip(matrix, vectors):
        row[t] = w
    labels_ = np.array([label for label, _ in vectors], float)
    texts = [(r["doc_id"], r["text"] or "") for r in docs_.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, sf).collect()}
    assert len(got) == len({i for i, _ in texts})
    for i, text in texts:
        q = np.zeros(len(index.vocabulary))
        t, w = index.vector(toxicity.terms(text))
        q[t] = w
        cosines = matrix @ q
        near = np.sort(cosines)[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose(got[i]["cosines"], near[near > 1e-12])
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i]["predicted"] == (got[i]["score"] >= 0.5)
        if len(near) < len(cosines) and len(near) and near[-1] - np.sort(cosines)[::-1][len(near)] > 1e-9:
            top = np.argsort(-cosines)[: len(near)]
            vote = (cosines[top] @ labels_[top] + 0.1 * prior) / (cosines[top].sum() + 0.1)
            assert abs(index.calibrated(vote) - got[i]["score"]) < 1e-9


def test_toxicity_on_held_out_rows(spark):
    """Recall, false alarms and rank of held-out documents of the middle table."""
    from concord.llm import queries

    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()}
    rows = [r for r in queries.op4_toxicity(spark, sf).select("doc_id", "held_out", "score").collect() if r["held_out"] and r["doc_id"] in labels]
    bad, good = (np.array([r["score"] for r in rows if labels[r["doc_id"]] == x]) for x in (1, 0))
    auc = (bad[:, None] > good).mean() + (bad[:, None] == good).mean() / 2
    print(f"held out: {len(bad)} toxic of {len(rows)}, recall {(bad >= 0.5).mean():.3f}, false alarms {(good >= 0.5).mean():.4f}, AUC {auc:.3f}")
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.02 and auc > 0.97


def test_toxicity_teaches_one_text_an_id(spark):
    """Repeated ids and labels don't crowd out others, whatever the order of rows."""
    rows = [(i, f"text {i} of {k}", None) for k in range(3) for i in range(40)]
    labels = spark.createDataFrame([(i, 0, x) for i in range(40) for x in ((0, 1) if i < 5 else (0, 0))], LABELS)
    got, prior = toxicity.training(docs(spark, rows), labels, most=30)
    again, _ = toxicity.training(docs(spark, rows[::-1]).repartition(7), labels, most=30)
    usable = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert got == again and len(got) == len({i for i, _, _ in got}) and {i for i, _, label in got if label} == {i for i in usable if i < 5}
    assert abs(prior - sum(i < 5 for i in usable) / len(usable)) < 1e-12


def test_copy_of_any_example_finds_it():
    """Also of those without a term that tells the labels apart."""
    rng = random.Random(4)
    text = lambda i: " ".join([f"own{i}", *(f"word{rng.randrange(900)}" for _ in range(40))]) + (" awful insult" if i % 9 == 0 and i % 2 else "")
    examples = [(i, text(i), int(i % 9 == 0)) for i in range(400)]
    index = toxicity.fit(examples, 0.1)
    for i, t, _ in examples:
        found, cosines = index.nearest(*index.vector(toxicity.terms(t)), toxicity.NEIGHBOURS)
        assert len(found) and index.ids[found[0]] == i and abs(cosines[0] - 1) < 1e-9


def test_repetitive_texts_need_little_memory():
    """An item and a long text of one phrase over and over; the same with edits."""
    import tracemalloc

    items = ["ha " * 266 + "ha", "ha hi " * 100 + "ha", "one two three four five six seven eight nine ten eleven twelve"]
    index = decontaminate.Index(np.arange(3), items, 0.05, decontaminate.Q)
    tracemalloc.start()
    got = index.matches("ha " * 100_000 + "end")
    edited = index.matches(("ha " * 30 + "hu ") * 3_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000
    assert [m[:2] for m in got] == [(0, 0)] and [m[:2] for m in edited] == [(0, edits(items[0], ("ha " * 30 + "hu ") * 30))]


def test_long_item_does_not_widen_others():
    words = [f"w{i}" for i in range(4000)]
    index = decontaminate.Index(np.arange(2), [" ".join(words), "a short item of some thirty letters or more"], 0.05, decontaminate.Q)
    assert index.half[1] <= 3 < index.half[0]


def test_blocks_of_benchmark_agree_with_one(spark, monkeypatch):
    """Three blocks are passes of their own, one index each, and find what one block finds."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 8)))
    items = [" ".join(word() for _ in range(20)) for _ in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, items[0])], "item_id long, text string")
    rows = docs(spark, [(i, f"before {items[i % 6]} after" if i % 4 else "clean " * 9, None) for i in range(30)] + [(30, items[0] + " " + items[5], None), (30, None, None)] + ODD)
    sizes = []
    make = decontaminate.Index.__post_init__
    monkeypatch.setattr(decontaminate.Index, "__post_init__", lambda self: (make(self), sizes.append(len(self.texts)))[0])
    shape = lambda out: sorted((str(r["doc_id"]), r["n_items"], sorted(r["item_ids"]), r["least_edits"]) for r in out.collect())
    one, three = (shape(decontaminate.report(rows, bench, block_chars=n)) for n in (1 << 20, 2 * len(items[0])))
    assert one == three and len(one) == rows.count() and sizes[0] == 6 and max(sizes[1:]) <= 3 and len(sizes) > 3
    assert decontaminate.filter_clean(rows, bench, block_chars=200).count() == sum(not n for _, n, _, _ in one)


def test_leaks_query_against_full_alignment(spark):
    """The query over the whole small table, each text and item aligned in full where a tenth of the item's q-grams is
    shared, which no item within its budget can fall short of."""
    from concord.llm import queries

    sf = "/root/testdata/sf0.001"
    items = {r["item_id"]: decontaminate.normalised(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    items = {i: t for i, t in items.items() if len(t) >= decontaminate.MIN_ITEM}
    grams = lambda t: {t[k : k + decontaminate.Q] for k in range(len(t) - decontaminate.Q + 1)}
    of_item = {i: grams(t) for i, t in items.items()}
    got = {r["doc_id"]: r for r in queries.op6_benchmark_decontamination(spark, sf).collect()}
    hits = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = decontaminate.normalised(r["text"] or "")
        mine, want = grams(text), {}
        for i, item in items.items():
            if 10 * len(mine & of_item[i]) >= len(of_item[i]):
                e = 0 if item in text else edits(item, text)
                if e <= decontaminate.budget(len(item), decontaminate.EDIT_RATE):
                    want[i] = e
        hits += len(want)
        assert sorted(got[r["doc_id"]]["item_ids"]) == sorted(want) and got[r["doc_id"]]["least_edits"] == min(want.values(), default=None)
    assert hits


def test_lines_in_parts_agree(spark, monkeypatch):
    """More boilerplate than is broadcast at once is taken in parts by host, null hosts too."""
    rows = docs(spark, [(i, f"menu {i % 3}\nown line {i}\nfooter of {s}\n\n", s) for i in range(90) for s in ("a", "b", "c", None)] + ODD)
    shape = lambda: sorted((str(r["doc_id"]), str(r["source"]), r["text"], r["n_dropped"]) for r in line_dedup.drop_boilerplate(rows).collect())
    whole = shape()
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 5)
    assert shape() == whole and sum(n for *_, n in whole) > 600


def test_cascade_order_follows_costs(spark):
    """The order comes from what rules cost and reject; verdicts don't depend on it."""
    rows = docs(spark, [(i, (PROSE if i % 2 else "ALL CAPS HERE " * 30), "a") for i in range(60)])
    slow = quality_rules.Rule("slow", F.regexp_count("text", F.lit(r"(\w+\s+){3,}Z")) > 0)
    fast = quality_rules.Rule("fast", F.col("text").startswith("ALL"))
    never = quality_rules.Rule("never", F.length("text") < 0)
    ordered = quality_rules.order_rules(rows, [slow, never, fast])
    assert ordered[0][0].name == "fast" and abs(ordered[0][2] - 0.5) < 1e-9 and all(seconds > 0 for _, seconds, _ in ordered)
    kept = [sorted((r["doc_id"], r["kept"]) for r in quality_rules.judge(rows, rules).collect()) for rules in ([slow, fast], [fast, slow])]
    assert kept[0] == kept[1]
    assert quality_rules.sample_of(docs(spark, [(i, "t", None) for i in range(5000)]), 400).count() in range(300, 500)


def test_label_model_against_enumeration():
    """Posteriors and one round of expectation-maximisation worked out document by document."""
    rng = random.Random(2)
    votes = [tuple(rng.choice((-1, 0, 1)) for _ in range(3)) for _ in range(200)]
    patterns = sorted(set(votes))
    counts = np.array([votes.count(p) for p in patterns], float)
    model = weak_quality.fit_labels(["a", "b", "c"], np.array(patterns), counts, rounds=1)
    prior, good, bad = 0.8, weak_quality.GOOD_SAYS, weak_quality.BAD_SAYS
    p = []
    for v in votes:
        g, b = prior, 1 - prior
        for x in v:
            g, b = g * good[x + 1], b * bad[x + 1]
        p.append(g / (g + b))
    assert abs(model.prior - sum(p) / len(p)) < 1e-12
    for j in range(3):
        for x in (-1, 0, 1):
            said = sum(q for q, v in zip(p, votes) if v[j] == x) + good[x + 1]
            assert abs(model.good[j, x + 1] - said / (sum(p) + 1)) < 1e-12
            said = sum(1 - q for q, v in zip(p, votes) if v[j] == x) + bad[x + 1]
            assert abs(model.bad[j, x + 1] - said / (len(p) - sum(p) + 1)) < 1e-12


def test_shapes_by_the_short_way_and_the_long(monkeypatch):
    words = ["word", "Word", "WORD", "W", "w", "WoRD,", "A.", "AB!", "x1", "12", "naïve", "Éa", "ÉÀ", "a--b", "...", "", "a,,", ",", "日本", "don't"]
    short = [weak_quality.shape(w) for w in words]
    monkeypatch.setattr(weak_quality, "_MARKS", frozenset())
    monkeypatch.setattr(weak_quality, "shape", weak_quality.shape)

    def long(word):
        for pattern, to in weak_quality._LETTERS:
            word = pattern.sub(to, word)
        return weak_quality._MANY.sub(r"\1\1", word)[:12]

    assert short == [long(w) for w in words]


def test_sample_covers_the_whole_table(spark):
    """Junk of a kind that only the last half of the table has is learned; copies of one text don't crowd others out."""
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) + ("." if k % 12 == 11 else "") for k in range(120))
    rows = [(i, prose(), "a") for i in range(400)] + [(400 + i, PROSE, "a") for i in range(400)]
    rows += [(800 + i, (prose() if i % 2 else " ".join(f"{w} | " for w in prose().split())), "a") for i in range(800)]
    table = docs(spark, rows).coalesce(1).repartitionByRange(8, "doc_id")
    sample = [r["text"] for r in weak_quality.sample_of(table, 200, weak_quality.Tables(spark, "t")).collect()]
    again = [r["text"] for r in weak_quality.sample_of(docs(spark, rows[::-1]), 200, weak_quality.Tables(spark, "t")).collect()]
    assert len(sample) == len(set(sample)) == 200 and sorted(sample) == sorted(again) and 40 < sum(" | " in t for t in sample) < 110
    got = {r["doc_id"]: r["kept"] for r in weak_quality.classify(table).collect()}
    assert not any(got[800 + i] for i in range(0, 800, 2)) and all(got[i] for i in range(400))


def test_quality_query_against_labels(spark):
    """The query over a whole table, held against its labels, which it never sees."""
    from concord.llm import queries

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null").collect()}
    rows = [(labels[r["doc_id"]], r["kept"]) for r in queries.op1_quality_classifier(spark, sf).collect() if r["doc_id"] in labels]
    kept = lambda q: sum(k for label, k in rows if label == q) / sum(label == q for label, _ in rows)
    print(f"kept: {kept(1):.4f} of good, {kept(0):.4f} of bad")
    assert kept(1) > 0.99 and kept(0) < 0.05


def test_mix_counts_repeats_of_one_document(spark):
    """Sources of one document over and over, of null ids with different texts, and of both."""
    rows = [(7, "same text here", "a")] * 300 + [(None, f"text {i} of many", "b") for i in range(300)] + [(i, "w " * 10, "c") for i in range(300)]
    out = mixing.mix(docs(spark, rows)).collect()
    assert len(out) == 900
    for name, size in (("a", 3), ("b", 4), ("c", 10)):
        part = [r for r in out if r["source"] == name]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= size / 2 + 1e-9 and all(r["taken"] <= 3 * r["size"] for r in part)
    count = lambda x: sorted((str(r["doc_id"]), r["source"], r["copies"]) for r in x)
    assert count(mixing.mix(docs(spark, rows).repartition(3)).collect()) == count(out)
    taken = mixing.mix_rows(docs(spark, rows)).groupBy("source").agg(F.sum(F.col("mixed_size") * F.col("copies").cast("long")).alias("n")).collect()
    assert {r["source"]: r["n"] for r in taken} == {s: sum(r["taken"] for r in out if r["source"] == s) for s in "abc"}


def test_mix_keeps_targets(spark):
    rng = random.Random(1)
    out = mixing.mix(docs(spark, [(i, "w " * rng.randrange(1, 50), rng.choice(["a", "b", "b", "b", None])) for i in range(400)])).collect()
    for source in {r["source_size"] for r in out}:
        part = [r for r in out if r["source_size"] == source]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 50
    assert all(r["taken"] <= 3 * r["size"] for r in out)


def test_long_varied_texts_need_no_more_memory(monkeypatch):
    """Bands are dropped as the text passes them; what is found doesn't depend on how many are counted at a time."""
    import tracemalloc

    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(150)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    items = [prose(60) for _ in range(500)]
    index = decontaminate.Index(np.arange(500), items, decontaminate.EDIT_RATE, decontaminate.Q)
    base = prose(150_000)
    parts = lambda n: " ".join([base[: n // 2].rsplit(" ", 1)[0], items[7], items[7], base[n // 2 : n].split(" ", 1)[1], items[3][:-4] + "zz"])
    monkeypatch.setattr(decontaminate, "PAIRS", 50_000)
    peaks = []
    for n in (100_000, 600_000):
        tracemalloc.start()
        found = index.bands(parts(n))
        peaks.append(tracemalloc.get_traced_memory()[1] - 60 * n)
        tracemalloc.stop()
        assert {x[0] for x in found} >= {3, 7} and [m[0] for m in index.matches(parts(n))] == [3, 7]
    assert peaks[1] < 1.5 * max(peaks[0], 20e6), peaks
    short = parts(20_000)
    some = index.bands(short)
    monkeypatch.setattr(decontaminate, "PAIRS", 10**9)
    assert index.bands(short) == some


def test_a_short_list_against_a_large_universe(spark, monkeypatch):
    """Few other keys pass the first filter, whatever their number, so that no later level is larger than it; a level
    beyond the bound deals the list in more parts."""
    levels = []
    build = url_filter.build_level
    monkeypatch.setattr(url_filter, "build_level", lambda *a: levels.append(build(*a)) or levels[-1])
    pages = spark.range(60_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 30_000, F.lit(".test/x")).alias("url"))
    hosts = spark.range(12).select(F.concat(F.lit("h"), F.col("id") * 2500, F.lit(".test")).alias("host"))
    blocked = lambda: sorted(r["page_id"] for r in url_filter.judge(pages, hosts=hosts).where("verdict = 'block'").collect())
    want = sorted(i for i in range(60_000) if i % 2500 == 0)
    assert blocked() == want and len(levels[0].words) >= max(len(x.words) for x in levels)
    assert levels[0].probes > 10 and all(x.probes == 6 for x in levels[1:])
    monkeypatch.setattr(url_filter, "MAX_BITS", 256)
    levels.clear()
    assert blocked() == want and max(len(x.words) for x in levels) <= 4


def test_stages_keep_rows_of_equal_and_null_ids(spark):
    texts = {k: " ".join(f"{k}{n}" for n in range(60)) for k in "pqr"}
    rows = docs(spark, [(1, texts["p"], "a"), (1, texts["p"], "a"), (1, texts["q"], "a"), (None, texts["r"], "a"), (None, texts["r"], None)])
    kept = corpus_pipeline.near_duplicates(spark, rows, "")
    assert sorted((r["doc_id"] or 0, r["text"][0]) for r in kept.collect()) == [(0, "r"), (1, "p"), (1, "q")]
    mixed = corpus_pipeline.mix_sources(spark, rows, "").collect()
    assert len(mixed) <= 5 and all(r["mixed_size"] == 60 for r in mixed)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_rows_of_one_id_are_judged_by_their_own_text(spark, monkeypatch, broadcast):
    """Q shares its id with a copy of P, which isn't the smallest of P's group; copies without an id go too."""
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", broadcast)
    p, q, r, s = (" ".join(f"{k}{n}" for n in range(90)) for k in "pqrs")
    rows = [(1, p, "a"), (5, p + " tail", "a"), (5, q, "a"), (7, r, "a"), (None, r, "a"), (None, r + " end", "b"), (None, s, "a"), (None, s, "a"), (9, q + " more", "b"), (9, "", "b"), (9, None, "b"), (5, q, "c")]
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, rows), "")
    assert sorted((str(x["doc_id"]), str(x["text"])) for x in kept.collect()) == sorted([("1", p), ("5", q), ("7", r), ("None", s), ("9", ""), ("9", "None")])
    found = ngram_join.join_components(docs(spark, rows), 5, 80).collect()
    assert sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in found) == sorted([("1", 86, "1"), ("5", 87, "1"), ("5", 86, "5"), ("5", 86, "5"), ("7", 86, "7"), ("None", 86, "7"), ("None", 87, "7"), ("None", 86, "None"), ("None", 86, "None"), ("9", 87, "5"), ("9", 0, "9"), ("9", 0, "9")])


def test_weak_labels_tell_junk(spark):
    junk = [(i, " ".join(f"w{k}&&&" for k in range(80)), "a") for i in range(20)] + [(20 + i, "same " * 90, "a") for i in range(20)]
    good = [(100 + i, PROSE + f" Tail{i} ends here.", "a") for i in range(160)]
    got = {r["doc_id"]: r["kept"] for r in weak_quality.classify(docs(spark, junk + good)).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in junk)


def test_long_repetition_is_junk(spark):
    """A sentence of twenty words, and a passage longer than the stretch over which variety is taken, again and again."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: " ".join(word() + ("." if k % 12 == 11 else "") for k in range(n))
    junk = [(i, (prose(20) + " ") * (40 + 20 * i), "a") for i in range(20)] + [(20 + i, (prose(2500) + " ") * 8, "a") for i in range(6)]
    good = [(100 + i, prose(200 + 40 * i), "a") for i in range(160)]
    texts = docs(spark, junk + good)
    votes = texts.select("doc_id", F.split(F.trim("text"), " ").alias("words"), "text").withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).select("doc_id", weak_quality.labellers()["variety"].alias("v"))
    assert {r["doc_id"] for r in votes.collect() if r["v"] == 0} == set(range(26))
    assert all((weak_quality.features(t, weak_quality.Shapes())[1] > 0.3) == (i < 100) for i, t, _ in junk + good)


def test_pipeline_stages(spark, tmp_path):
    item = " ".join("bench mark alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split())
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    name = lambda n: "".join("bcdfghjklm"[int(c)] + "a" for c in str(n))
    texts = [(i, " ".join(f"{name(i)}{name(k % 61)} {name(k)} stands." for k in range(80)), "ab"[i % 2]) for i in range(60)]
    texts += [(60, texts[0][1], "a"), (61, texts[1][1] + " more.", "a"), (62, texts[2][1] + " " + item + ".", "b"), (63, "##$$ %% " * 60, "a")]
    rows = docs(spark, texts)
    names = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, str(tmp_path)).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == names
        ids = {r["doc_id"] for r in rows.select("doc_id").collect()}
        if name == "benchmark decontamination":
            assert ids == set(range(60))
    assert ids <= set(range(60)) and rows.where("copies < 1").count() == 0
