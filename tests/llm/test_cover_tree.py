"""Exact top-k against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm.cover_tree import CoverTree, DualTree, coarse_centres, reach_of, search_pair, top_k

SMALL = DualTree(k=4, sample=40, cells=4, block=16, pack=5, fan=3, leaf=4, seeds=2)


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(1024 * x) for x in v]


def brute(rows, k, every):
    points = [(i, whole(v)) for i, v in rows]
    found = []
    for n, (q, a) in enumerate(points):
        if a is None or q is None or q % every:
            continue
        scores = [
            (-sum(x * y for x, y in zip(a, b)), i)
            for m, (i, b) in enumerate(points)
            if m != n and b is not None and i is not None and len(a) == len(b)
        ]
        found += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def searched(spark, rows, params=SMALL, every=3):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = vectors.selectExpr("*", "1 AS dim", "'x' AS row", "2 AS block")
    return sorted(map(tuple, top_k(vectors, F.col("vec_id") % every == 0, params).collect()))


def cloud(n, dim=6, seed=2):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(heads)]) for i in range(n)]


@pytest.mark.parametrize("params", [SMALL, DualTree(k=4)])
def test_matches_all_products(spark, params):
    rows = cloud(130)
    assert searched(spark, rows, params) == brute(rows, params.k, 3)


def test_odd_rows(spark):
    rows = cloud(30)
    rows += [(33, None), (36, [1.0, None]), (39, [math.nan] * 6), (42, [math.inf] * 6), (None, [0.5] * 6)]
    rows += [(45, [0.0] * 6), (48, []), (49, []), (51, [0.5, 0.5]), (54, [9.0] * 6)]
    rows += [(3, rows[3][1]), (3, [0.1] * 6), (60, rows[9][1]), (61, rows[9][1])]
    assert searched(spark, rows) == brute(rows, 4, 3)


def test_copies_and_ties(spark):
    """A third of all rows are one vector: equal scores, and leaves larger than a leaf is."""
    rows = cloud(60) + [(100 + i, [0.7] * 6) for i in range(40)]
    assert searched(spark, rows) == brute(rows, 4, 3)


def test_few_rows_and_none(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(3, [1.0])]) == []
    assert searched(spark, [(1, [1.0]), (2, [1.0])]) == []
    rows = [(3, [1.0, 2.0]), (4, [0.5, -2.0])]
    assert searched(spark, rows) == brute(rows, 4, 3)


def test_long_products_are_exact(spark):
    """Sums beyond what doubles hold; those beyond a long are given as the nearest long."""
    rows = [(i, [2.0**20 + i / 1024, 2.0**19 + 3 * i / 1024]) for i in range(12)]
    assert searched(spark, rows) == brute(rows, 4, 3)
    got = searched(spark, [(0, [1e30, 1.0]), (1, [1e30, 2.0])])
    assert got == [(0, 1, 1, 2**63 - 1)]


def test_tree_covers_separates_and_nests():
    points = np.floor(np.random.default_rng(4).normal(size=(300, 5)) * 100)
    tree = CoverTree(points, fan=4, leaf=8)
    assert sorted(tree.order) == list(range(300))
    for i, kids in enumerate(tree.kids):
        mine = tree.order[tree.first[i] : tree.last[i]]
        gaps = np.linalg.norm(points[mine] - points[tree.centre[i]], axis=1)
        assert gaps.max() == pytest.approx(tree.radius[i]) and tree.centre[i] in mine
        if kids:
            assert tree.centre[kids[0]] == tree.centre[i]
            assert [tree.first[k] for k in kids[1:]] == [tree.last[k] for k in kids[:-1]]
            centres = points[[tree.centre[k] for k in kids]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)[np.triu_indices(len(kids), 1)]
            assert apart.min() >= max(tree.radius[k] for k in kids) - 1e-9
        else:
            assert len(mine) <= 8 or tree.radius[i] == 0


def test_reach_is_never_below_a_product():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (np.floor(rng.normal(size=(20, 4)) * rng.integers(1, 2000)) for _ in range(2))
        ca, cb = a.mean(axis=0), b[0]
        ra, rb = (np.linalg.norm(x - c, axis=1).max() for x, c in ((a, ca), (b, cb)))
        most = (a @ b.T).max()
        assert most <= reach_of(ca @ cb, np.linalg.norm(ca), ra, np.linalg.norm(cb), rb)


def test_far_nodes_are_not_compared():
    """Two clouds far apart: the pairs of nodes that cannot reach are dropped."""
    rng = np.random.default_rng(1)
    near, far = rng.normal(size=(400, 4)) + 50, rng.normal(size=(400, 4)) - 50
    points = np.floor(np.concatenate([near, far]) * 100)
    rows = np.arange(800)
    queries = {"rows": rows[:20], "points": points[:20]}
    data = {"ids": rows, "rows": rows, "points": points}
    hits = search_pair(queries, data, [-math.inf] * 20, DualTree(leaf=16))
    assert hits.compared <= 20 * 400
    for i, found in enumerate(hits.found):
        scores = sorted((-(points[i] @ points[j]), j) for j in range(800) if j != i)[:10]
        assert [(s, r) for s, _, r in found] == scores


def test_coarse_centres_follow_the_tree():
    points = np.array([[float(i // 10 * 100), 0.0] for i in range(40)])
    assert sorted(map(tuple, coarse_centres(points, SMALL))) == [(0.0, 0.0), (100.0, 0.0), (200.0, 0.0), (300.0, 0.0)]
    assert coarse_centres(points[:0], SMALL).shape == (0, 2)
