import math

import numpy as np
import pytest

from shelfcast.llm.embedding_dedup import Descent, audit_recall, embedding_links


def brute(rows, threshold=0.95):
    vectors = {}
    for ident, v in rows:
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            v = np.array(v) / np.abs(v).max()
        vectors[ident] = v / np.linalg.norm(v) if ok and ident is not None else None
    ids = [i for i in vectors if i is not None]
    near = {i: [j for j in ids if j != i and linked(vectors[i], vectors[j], threshold)] for i in ids}
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(near[i]), min(seen))
    return out


def linked(a, b, threshold):
    return a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def got(table, **changes):
    found = embedding_links(table, params=Descent(**changes))
    return {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}


def clustered(seed, n=400, dims=24, noise=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    rows = rng.standard_normal((n, dims))
    for i in range(0, n, 2):
        rows[i] = centres[rng.integers(12)] * rng.uniform(0.5, 2) + noise * rng.standard_normal(dims)
    return rows


def test_agrees_with_brute_force(spark):
    rows = [(i * 3, v.tolist()) for i, v in enumerate(clustered(1))]
    want = brute(rows)
    assert max(n for n, _ in want.values()) > 16  # longer than the lists of the graph
    assert got(frame(spark, rows), leaf=16, tables=3, chunk=8) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = clustered(2, 6, 4)
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0, 0.0]), (4, [1.0, None, 0.0, 0.0]), (5, [nan, 1.0, 0.0, 0.0]),
        (6, [inf, 0.0, 0.0, 0.0]), (7, [1.0, 0.0, 0.0, 0.0]), (8, [1.0, 0.0, 0.0, 0.0]), (9, [2.0, 0.0, 0.0, 0.0]),
        (10, [1.0, 0.0]), (11, [1e200, 0.0]), (12, [-1.0, 0.0]), (13, v[0].tolist()), (14, [1e-300, 0.0, 0.0, 0.0]),
    ]
    assert got(frame(spark, rows)) == brute(rows)


def test_many_copies_and_other_columns(spark):
    base = clustered(3, 30, 8)
    rows = [(i, base[i % 30 if i % 3 else 0].tolist()) for i in range(300)]
    table = frame(spark, rows).selectExpr("*", "1 AS id", "2 AS n", "3 AS component", "4 AS label")
    assert got(table) == brute(rows)


def test_nulls_and_empty(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0])]
    assert got(frame(spark, rows)) == {None: (0, None), 1: (0, 1)}
    assert got(frame(spark, rows).limit(0)) == {}


@pytest.mark.parametrize("seed", [4, 5])
def test_recall_on_pairs_among_noise(spark, seed):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((1500, 32))
    rows[1::2] = rows[0::2] + 0.15 * rng.standard_normal((750, 32))
    table = [(i, v.tolist()) for i, v in enumerate(rows)]
    want, found = brute(table), got(frame(spark, table))
    total = sum(n for n, _ in want.values())
    assert total > 1000
    assert sum(min(found[i][0], want[i][0]) for i in want) >= 0.98 * total
    assert all(found[i][0] <= want[i][0] for i in want)


def tight(rng, centre, n, spread):
    rows = centre + spread * rng.standard_normal((n, len(centre)))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def test_links_between_full_lists(spark):
    """Two groups of 40: the nearest 32 of each vector are of its own group."""
    rng = np.random.default_rng(6)
    a, b = np.eye(16)[:2]
    groups = np.r_[tight(rng, a, 40, 0.002), tight(rng, 0.9575 * a + math.sqrt(1 - 0.9575**2) * b, 40, 0.002)]
    sims = groups @ groups.T
    assert sims[:40, :40].min() > sims[:40, 40:].max() and sims[:40, 40:].min() >= 0.95
    rows = [(i, v.tolist()) for i, v in enumerate(np.r_[groups, rng.standard_normal((60, 16))])]
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("lost, low, high", [(0, 1.0, 1.0), (5, 0.7, 0.85), (20, 0.0, 0.0)])
def test_audit_is_not_outweighed_by_a_hot_group(spark, lost, low, high):
    """300 vectors that all link, and 20 pairs of which some were missed."""
    rng = np.random.default_rng(7)
    hot = tight(rng, np.eye(32)[0], 300, 0.002)
    pairs = rng.standard_normal((40, 32))
    pairs[1::2] = pairs[::2] + 0.02 * rng.standard_normal((20, 32))
    pairs /= np.linalg.norm(pairs, axis=1)[:, None]
    parts = [0] * 300 + [300 + (i if i < 2 * lost else i // 2 * 2) for i in range(40)]
    rows = [(i, parts[i], 1, bytearray(v.tobytes())) for i, v in enumerate(np.r_[hot, pairs])]
    vectors = spark.createDataFrame(rows, "id long, component long, n long, full binary")
    counts = [(i, 299) for i in range(300)] + [(300 + i, 1) for i in range(2 * lost, 40)]
    recall, _ = audit_recall(vectors, spark.createDataFrame(counts, "id long, linked long"), Descent())
    assert low <= recall <= high


def test_all_are_compared_where_recall_stays_low(spark, monkeypatch):
    """A search that finds nothing leaves every link to the last comparison."""
    from shelfcast.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "_verified", lambda graph, vectors, params: graph.select("v", "u").limit(0))
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(8, 80, 12))]
    assert got(frame(spark, rows), rounds=1, widest=8, chunk=16) == brute(rows)


def test_repeated_ids(spark):
    """A row is a vector, whatever its id: one row each, linked by the vectors alone."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, -0.0], [0.0, 0.99, 0.05]
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (4, [0.0, 1.0, 0.0]), (5, [0.0, 0.0, 1.0]), (5, None)]
    found = embedding_links(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(
        [(1, 1, 1), (2, 1, 1)] + [(1, 3, 1)] * 2 + [(3, 3, 1), (4, 3, 1), (5, 0, 5), (5, 0, 5)]
    )
