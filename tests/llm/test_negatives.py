"""Hard negatives against brute force; packing, boxes and pruning."""

import math
import random

import numpy as np
import pytest

from conftest import SF001, SF01
from hitlens.llm import negatives, registry


def brute(rows, asked=lambda i: i % 100 == 0, top=5):
    """rows: (vec_id, vector, label) after any change of labels."""
    held = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    rank = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for k, (i, v, label) in enumerate(held):
        if i is None or not asked(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(held) if m != k]
        for p, j, _ in sorted((s for s in scored if s[2] == label), key=rank)[:top]:
            fits = sorted((s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p), key=rank)[:top]
            out += [(i, j, n, s[1], p, s[0]) for n, s in enumerate(fits, 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def table(spark, path):
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]


@pytest.mark.parametrize("path", [SF001, SF01])
def test_query_equals_brute_force(spark, path, monkeypatch):
    got = registry.op13_hard_negatives(spark, path)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(table(spark, path)))


def made(spark, rows, asked=100, parts=3):
    schema = "vec_id long, embedding array<float>, label int, row long, id string, v string, c int, strip int"
    frame = spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], schema).repartition(parts)
    got = negatives.mine(spark, frame, registry.F.col("id") % asked == 0)
    return sorted((tuple(r) for r in got.collect()), key=key)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "STRIP", 16)
    monkeypatch.setattr(negatives, "LEAF", 4)
    r = random.Random(4)
    nan, inf = float("nan"), float("inf")
    vector = lambda: [r.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)]
    rows = [(k, vector(), r.choice([1, 1, 1, 2, 3])) for k in range(150)]
    rows += [(200, vector(), None), (201, None, 1), (202, [nan, 1.0, 1.0], 2), (203, [inf, 0.0, 0.0], 2),
             (204, [None, 1.0, 1.0], 1), (None, vector(), 1), (None, [1.0, 1.0, 1.0], 2), (205, [], 1), (206, [1.0], 2),
             (207, [1.0, 1.0, 1.0, 1.0], 1)]
    rows += [(300, [1.0, 0.5, 1.0], 1)] * 3 + [(300, [1.0, 0.5, 0.75], 2)]      # rows of one id
    rows += [(400 + k, [1.0, 1.0, 1.0], 1 + k % 2) for k in range(60)]          # one vector, many rows
    got = made(spark, rows, asked=10)
    assert got == sorted(brute(rows, lambda i: i % 10 == 0), key=key)


def test_one_label_and_no_rows(spark):
    assert made(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert made(spark, []) == []
    assert made(spark, [(0, [1.0], 1)]) == []


def test_str_packing_covers_every_row_once():
    r = np.random.default_rng(7)
    for n, d, leaf in [(1, 3, 4), (1000, 5, 16), (777, 1, 10), (300, 64, 7), (50, 2, 100), (200, 0, 9)]:
        x = r.integers(-200, 200, (n, d))
        tiles = negatives.str_order(x, leaf)
        assert sorted(np.concatenate(tiles).tolist()) == list(range(n)) and max(map(len, tiles)) <= leaf
        assert len(tiles) <= 2 * -(-n // leaf) + 1


def test_boxes_bound_every_score_and_pruning_saves_work():
    r = np.random.default_rng(8)
    centres = r.integers(-200, 200, (12, 4))
    x = (centres[r.integers(0, 12, 4000)] + r.integers(-6, 7, (4000, 4))).astype(np.int32)
    tree = negatives.Tree(negatives._load(negatives.pack(3, np.arange(4000), np.arange(4000), x, leaf=16, fan=4)))
    query = r.integers(-200, 200, (1, 4)).astype(np.float64)
    low, high = (b[0] for b in tree.bounds(query))
    for node in range(tree.leaves):
        scores = tree.x[tree.first[node]:tree.last[node]] @ query[0]
        assert low[node] <= scores.min() and scores.max() <= high[node]
    assert low[-1] == low.min() and high[-1] == high.max()
    every = np.sort(tree.x @ query[0])[::-1]
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.x = tree.x.view(Counted)
    best = negatives._Best(-np.inf, np.inf, 5)
    negatives.search([(tree, low.tolist(), high.tolist())], query[0], [best])
    assert [-f[0] for f in best.found] == every[:5].tolist()
    assert sum(seen) < 1000
    inner = negatives._Best(float(every[2000]) - 50, float(every[2000]), 5)
    seen.clear()
    negatives.search([(tree, low.tolist(), high.tolist())], query[0], [inner])
    assert [-f[0] for f in inner.found] == every[every <= every[2000]][:5].tolist()
    assert sum(seen) < 3000
