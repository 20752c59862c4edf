"""Hard negatives against brute force over all rows."""

import math
import random

import numpy as np
import pytest

from concord.llm import hard_negatives, queries

SHAPE = "vec_id long, embedding array<float>, label int, id string, block string"


def brute(rows, every=100):
    kept = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, _, v in kept), default=0)
    kept = [(i, label, np.array(v + [0] * (width - len(v)), object)) for i, label, v in kept]
    late = lambda i: (i is None, i or 0)
    out = []
    for n, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((int(v @ w) if width else 0, i, other) for m, (i, other, w) in enumerate(kept) if m != n), key=lambda x: (-x[0], late(x[1])))
        for p, i, _ in [x for x in scored if x[2] == label][:5]:
            for rank, (s, j, _) in enumerate([x for x in scored if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p][:10]):
                out.append((anchor, i, rank + 1, j, p, s))
    return sorted(out, key=str)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE)
    return sorted(map(tuple, hard_negatives.mine(df, **how).collect()), key=str)


def f32(rng, n, scale=1.0):
    return [float(x) for x in np.float32(rng.normal(size=n) * scale)]


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = queries.op11_hard_negatives(spark, "/root/testdata/sf0.01")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block,anchors", [(1024, 16_384), (8, 4), (3, 1)])
def test_odd_rows_in_blocks_of_any_size(spark, monkeypatch, block, anchors):
    """Ties, copies, repeated and null ids, nulls, non-finite components, short and empty vectors, one label only."""
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rng = np.random.default_rng(3)
    copied = f32(rng, 5)
    rows = [(i, copied if i % 3 == 0 else f32(rng, 5), i % 4) for i in range(150)]
    rows += [(100, f32(rng, 5), 1), (100, copied, 2), (None, copied, 1), (None, f32(rng, 5, 3.0), 3), (151, None, 1), (152, f32(rng, 5), None), (153, [1.0, None, 1.0, 1.0, 1.0], 2), (154, [float("nan")] * 5, 2), (155, [float("inf")] * 5, 2), (156, [], 2), (157, f32(rng, 2), 2), (-200, copied, 0), (0, [0.0] * 5, 7)]
    random.Random(1).shuffle(rows)
    assert mined(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f32(rng, 3, 1e5), i % 2) for i in range(40)]
    assert mined(spark, rows, every=10) == brute(rows, 10) != []
    assert mined(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2)]) == []


def test_no_rows_no_partner(spark):
    assert mined(spark, []) == mined(spark, [(0, None, 1)]) == mined(spark, [(0, [1.0], 1), (1, [0.5], 2)]) == mined(spark, [(0, [], 1), (1, [], 1)]) == []


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_the_curve_goes_from_cell_to_neighbour(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    order = np.argsort(np.array([int.from_bytes(k) for k in hard_negatives.hilbert_keys(cells, bits)]))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_zone_maps_bound_scores():
    rng = np.random.default_rng(5)
    v, block = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (50, 6))
    low, high = hard_negatives.bounds(v, block.min(0), block.max(0))
    scores = v @ block.T
    assert (low <= scores.min(1)).all() and (scores.max(1) <= high).all()
