"""Hard negatives against all inner products, and the tree's own invariants."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanweave.llm import cover_tree, hard_negatives


def whole(rows):
    """One (label, vector) per id, of the rows that take part."""
    out = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        out[i] = min(out.get(i, row), row)
    return out


def brute(rows, every=5):
    kept, out = whole(rows), []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for anchor, (label, vector) in kept.items():
        if anchor % every:
            continue
        order = sorted((-dot(vector, v), i) for i, (_, v) in kept.items() if i != anchor)
        for ps, positive in [(-s, i) for s, i in order if kept[i][0] == label][:5]:
            fits = [(-s, i) for s, i in order if kept[i][0] != label and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(anchor, positive, rank, i, ps, s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def result(df, every=5):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0).collect())


def table(spark, rows):
    rows = [(*r, "x", 1) for r in rows]
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, score string, part int").repartition(3)


def vectors(n, d=8, seed=0):
    draw = random.Random(seed)
    rows = [(i, draw.randrange(4), [draw.randrange(-64, 65) / 64 for _ in range(d)]) for i in range(n)]
    return rows + [(n + k, k % 4, rows[3][2]) for k in range(200)]  # one vector many times: ties


@pytest.mark.parametrize("tree_rows, block", [(8192, 512), (60, 7)])
def test_equals_all_inner_products(spark, monkeypatch, tree_rows, block):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = vectors(300)
    assert result(table(spark, rows)) == brute(rows) != []


def test_awkward_rows(spark):
    one = [0.5, 0.25, -0.5]
    rows = [(0, 1, one), (0, 1, one), (0, 0, one), (1, 0, one), (2, 1, [0.25, 0.25]), (3, 1, []), (4, 1, None), (5, None, one), (None, 1, one)]
    rows += [(6, 1, [0.5, None, 0.5]), (7, 1, [float("nan"), 0.0, 0.0]), (8, 1, [float("inf"), 0.0, 0.0]), (9, 2, [9.0] * 5), (10, 3, one), (15, 0, one), (20, 7, one)]
    rows += [(25 + i, i % 2, [0.1 * i, 0.3, -0.2]) for i in range(12)]
    assert result(table(spark, rows)) == brute(rows) != []
    assert result(table(spark, rows).limit(0)) == []
    assert result(table(spark, rows), every=1000) == brute(rows, 1000)


def test_radii_cover_and_bound():
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(8, 16)) * 200
    x = np.floor(centers[draw.integers(0, 8, 3000)] + draw.normal(size=(3000, 16)) * 5).astype(np.int32)
    tree = cover_tree.build(x, np.arange(3000), draw.integers(0, 3, 3000))
    assert sorted(tree.ids) == list(range(3000))
    tree.vectors = tree.vectors.astype(np.int64)
    opened = []
    offer = cover_tree.Best.offer

    class Counting(cover_tree.Best):
        def offer(self, scores, ids):
            opened.append(len(ids))
            offer(self, scores, ids)

    query = x[0].astype(np.int64)
    best = Counting(-np.inf, np.inf, 5)
    cover_tree.search(tree, query, int(tree.labels[0]), True, None, [best])
    scores = tree.vectors @ query
    fits = np.flatnonzero(tree.labels == tree.labels[0])
    want = fits[np.lexsort((tree.ids[fits], -scores[fits]))][:5]
    assert best.ids.tolist() == tree.ids[want].tolist()
    assert sum(opened) < 0.5 * len(fits)  # most nodes are skipped on clustered vectors


@pytest.mark.parametrize("scale", [1, 3000, 1 << 18])  # products exact as float32, float64, whole numbers
def test_block_equals_single_searches(scale):
    draw = np.random.default_rng(scale)
    x = draw.integers(-128, 129, (900, 12)) * scale
    x[draw.integers(0, 900, 200)] = x[5]  # ties
    labels, ids = draw.integers(0, 4, 900), draw.permutation(900)
    trees = [cover_tree.build(x[k::3].astype(np.int32), ids[k::3], labels[k::3]) for k in range(3)]
    asked = np.arange(0, 900, 9)
    top = np.abs(x[asked] @ x.T).max()
    low = np.stack([draw.integers(-top, top, len(asked)), np.full(len(asked), cover_tree.LEAST), np.full(len(asked), top)], axis=1)
    high = np.stack([low[:, 0] + top // 3, np.full(len(asked), cover_tree.MOST), np.full(len(asked), -top)], axis=1)  # the last window is empty
    for same in (True, False):
        block = cover_tree.Block(x[asked], ids[asked], labels[asked], low, high, 7)
        singles = {(i, w): cover_tree.Best(float("-inf") if w == 1 else low[i, w], float("inf") if w == 1 else high[i, w], 7) for i in range(len(asked)) for w in (0, 1)}
        for tree in trees:
            cover_tree.search_all(cover_tree.Tree.from_bytes(tree.to_bytes()), block, same)
            for i, a in enumerate(asked):
                cover_tree.search(tree, x[a], labels[a], same, ids[a], [singles[i, 0], singles[i, 1]])
        block.settle()
        want = [(i * 3 + w, s, o) for (i, w), b in sorted(singles.items()) for s, o in zip(b.scores.tolist(), b.ids.tolist())]
        assert list(zip(*(c.tolist() for c in block.held))) == want != []


@pytest.mark.parametrize("look", [1, 2])
def test_first_look_changes_nothing(spark, monkeypatch, look):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "HELD", 1)  # a group for each tree
    monkeypatch.setattr(hard_negatives, "LOOK", look)
    rows = vectors(300)
    assert result(table(spark, rows)) == brute(rows) != []


def test_what_a_search_moves(spark, monkeypatch):
    """No broadcast, and neither trees nor tasks for each block of anchors."""
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    df = table(spark, vectors(300))
    searched, kind = [], type(df)
    run = kind.mapInArrow

    def seen(self, *args, **kwargs):
        if "tree" in self.columns:
            trees = [r["tree"] for r in self.collect() if r["tree"] is not None]
            plan = self._jdf.queryExecution().executedPlan().toString()  # as it was run
            searched.append((len(trees) - len({bytes(t) for t in trees}), "Broadcast" in plan, self.rdd.getNumPartitions()))
        return run(self, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    result(df)
    assert len(searched) == 2
    for again, broadcast, tasks in searched:
        assert again == 0 and not broadcast and tasks <= 4
