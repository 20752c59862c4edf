"""The pipeline over a whole small table, each stage held against a plain version over that stage's own input."""

import duckdb
import pytest
from test_operators import edits

import corpus_pipeline
from concord.llm import decontaminate, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Folders of the pipeline's input and of what each stage gives."""
    root = tmp_path_factory.mktemp("pipeline")
    paths = [f"{SF}/documents.parquet"]
    for name, stage in corpus_pipeline.STAGES:
        paths.append(str(root / name.replace(" ", "_")))
        stage(spark, spark.read.parquet(paths[-2]), SF).write.parquet(paths[-1])
    return paths


def rows(spark, path, *columns):
    return sorted(map(tuple, spark.read.parquet(path).select(*columns).collect()), key=str)


def by_sql(path, sql):
    with duckdb.connect() as c:
        c.execute(f"create view documents as select * from '{path}{'' if path.endswith('.parquet') else '/*.parquet'}'")
        found = c.execute(sql)
        names = [d[0] for d in found.description]
        return [dict(zip(names, r)) for r in found.fetchall()]


DOC = ("doc_id", "text", "lang", "source", "n_chars")


def test_classifier_keeps_whole_rows_and_good_ones(spark, stored):
    before, after = (rows(spark, p, *DOC) for p in stored[:2])
    assert set(after) <= set(before)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()}
    kept = {r[0] for r in after}
    good, bad = ([i for i, *_ in before if labels.get(i) == q] for q in (1, 0))
    assert sum(i in kept for i in good) > 0.97 * len(good) and sum(i in kept for i in bad) < 0.1 * max(1, len(bad))


def test_line_dedup_by_sql(spark, stored):
    want = {(r["doc_id"], r["text"]) for r in by_sql(stored[1], oracle.LINES)}
    assert {(i, t) for i, t, *_ in rows(spark, stored[2], *DOC)} == want
    assert all(n == len(t) for _, t, _, _, n in rows(spark, stored[2], *DOC))


def test_near_copies_by_all_pairs(spark, stored):
    before = rows(spark, stored[2], *DOC)
    sets = []
    for _, text, *_ in before:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    holders, root = {}, list(range(len(before)))
    for n, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(n)

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, s in enumerate(sets):
        for m in {m for g in s for m in holders[g] if m < n}:
            both = len(s & sets[m])
            if 100 * both >= 80 * (len(s) + len(sets[m]) - both):
                a, b = find(n), find(m)
                if a != b:
                    first, other = sorted((a, b), key=lambda k: before[k][0])
                    root[other] = first
    assert rows(spark, stored[3], *DOC) == sorted((r for n, r in enumerate(before) if find(n) == n), key=str)
    assert len(rows(spark, stored[3], *DOC)) < len(before)


def test_leaks_by_full_alignment(spark, stored):
    items = [decontaminate.normalised(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = lambda t: {t[k : k + decontaminate.Q] for k in range(len(t) - decontaminate.Q + 1)}
    items = [(t, grams(t)) for t in items if len(t) >= decontaminate.MIN_ITEM]

    def clean(text):
        text = decontaminate.normalised(text or "")
        mine = grams(text)
        return not any(10 * len(mine & g) >= len(g) and (t in text or edits(t, text) <= decontaminate.budget(len(t), decontaminate.EDIT_RATE)) for t, g in items)

    before = rows(spark, stored[3], *DOC)
    want = [r for r in before if clean(r[1])]
    assert rows(spark, stored[4], *DOC) == want and len(want) < len(before)


def test_mix_by_sql(spark, stored):
    want = sorted((r["doc_id"], r["size"], round(r["target"], 6), r["copies"]) for r in by_sql(stored[4], oracle.MIX) if r["copies"])
    got = [(i, s, round(t, 6), k) for i, s, t, k in rows(spark, stored[5], "doc_id", "mixed_size", "mixed_target", "copies")]
    assert sorted(got) == want


def test_run_gives_what_the_stages_give(spark, stored):
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "copies").collect())) == sorted(rows(spark, stored[5], "doc_id", "copies"))
