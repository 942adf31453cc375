"""Exact top-k by inner product with a dual-tree search.

Rows, queries and data alike, are put in the order of one coarse tree over a bounded sample; runs
of that order are blocks of data and packs of queries. Every block and pack has a cover tree of its
own, and what is compared is pairs of trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import written
from shelfcast.llm.ordering import numbered


@dataclass(frozen=True)
class DualTree:
    k: int = 10
    scale: float = 1024.0  # components become floor(scale * component)
    sample: int = 4096  # rows that the coarse tree is made from, least by hash
    cells: int = 256  # leaves of the coarse tree if they were even
    block: int = 4096  # rows of a block
    pack: int = 1024  # queries of a pack
    fan: int = 8  # children of a node
    leaf: int = 64  # points below which a node is not divided
    seeds: int = 4  # blocks that each pack meets first, for its queries' first worst scores


class CoverTree:
    """A cover tree of the rows of a matrix, made from the top: the children of a node are a net
    of its points, each the farthest from those before it and the first the node's own centre, and
    a point belongs to the nearest. So centres of a net are at least as far apart as any point is
    from its own (separation, covering), and a centre stays one further down (nesting). ``radius``
    is the measured cover of a node, copies of one point are one leaf whatever their number.

    Node ``i`` covers ``order[first[i]:last[i]]``; its children are ``kids[i]``.
    """

    def __init__(self, points: np.ndarray, fan: int, leaf: int):
        self.order = np.arange(len(points))
        self.first, self.last, self.centre, self.radius, self.kids = [], [], [], [], []
        if not len(points):
            return
        away = _distances(points, points[0])
        self._node(0, len(points), 0, away.max())
        todo = [(0, away)]
        while todo:
            node, away = todo.pop()
            first, last = self.first[node], self.last[node]
            if last - first <= leaf or self.radius[node] == 0:
                continue
            mine = self.order[first:last]
            owner = np.zeros(len(mine), np.int64)
            centres = [self.centre[node]]
            while len(centres) < fan and away.max() > 0:
                far = mine[away.argmax()]
                reach = _distances(points[mine], points[far])
                closer = reach < away
                owner[closer], away = len(centres), np.where(closer, reach, away)
                centres.append(far)
            by_owner = np.argsort(owner, kind="stable")
            self.order[first:last], away, owner = mine[by_owner], away[by_owner], owner[by_owner]
            edges = np.searchsorted(owner, np.arange(len(centres) + 1))
            for centre, a, b in zip(centres, edges[:-1], edges[1:]):
                kid = self._node(first + a, first + b, centre, away[a:b].max())
                self.kids[node].append(kid)
                todo.append((kid, away[a:b]))

    def _node(self, first: int, last: int, centre: int, radius: float) -> int:
        self.first.append(int(first))
        self.last.append(int(last))
        self.centre.append(centre)
        self.radius.append(float(radius))
        self.kids.append([])
        return len(self.first) - 1


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def coarse_centres(points: np.ndarray, params: DualTree) -> np.ndarray:
    """The centres of a cover tree's leaves, in the order of the tree, so that near ones lie near
    each other."""
    tree = CoverTree(points, params.fan, max(-(-len(points) // params.cells), 1))
    leaves = sorted((tree.first[i], tree.centre[i]) for i, kids in enumerate(tree.kids) if not kids)
    return points[[c for _, c in leaves]] if leaves else points


def reach_of(product, centre_q, radius_q, centre_d, radius_d):
    """No inner product between the points that two nodes cover is more than this: the centres'
    product, and each radius with the other's length (Cauchy and Schwarz). The slack is far above
    what doubles lose."""
    slack = 1e-9 * (centre_q + radius_q) * (centre_d + radius_d) + 0.5
    return product + radius_q * centre_d + radius_d * centre_q + radius_q * radius_d + slack


def _exact(q: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matrices in a type in which their products are exact: doubles hold whole numbers up to
    2 ** 53, longer ones are Python's."""
    most = np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * max(q.shape[1], 1)
    if most < 2**53:
        return q, d
    whole = np.frompyfunc(int, 1, 1)
    return whole(q), whole(d)


class Hits:
    """The k best (score, id, row) of each query so far, equal scores to the smaller id, then to
    the smaller row, and how many products were worked out for them."""

    def __init__(self, worst: list, k: int):
        self.k, self.floor, self.compared = k, list(worst), 0
        self.found: list[list[tuple]] = [[] for _ in worst]

    def offer(self, query: int, scores, ids, rows) -> None:
        best = self.found[query] + [(-s, i, r) for s, i, r in zip(scores, ids, rows)]
        best.sort()
        self.found[query] = best[: self.k]
        if len(best) >= self.k:
            self.floor[query] = max(self.floor[query], -best[self.k - 1][0])


def search_pair(queries: dict, data: dict, worst: list, params: DualTree) -> Hits:
    """The best of one block's points for each query of a pack, of those that reach the query's
    ``worst`` score (-inf: any). Pairs of nodes are taken nearest first and dropped when not even
    their radii let them reach the worst k-th score of the query node. ``queries`` and ``data``
    hold ids, rows and points."""
    q, d = queries["points"], data["points"]
    hits = Hits(worst, params.k)
    q_tree, d_tree = (CoverTree(x, params.fan, params.leaf) for x in (q, d))
    if not q_tree.first or not d_tree.first:
        return hits
    q_exact, d_exact = _exact(q, d)
    q_length, d_length = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (q, d))
    q_radius, d_radius = np.array(q_tree.radius), np.array(d_tree.radius)
    q_centre, d_centre = np.array(q_tree.centre), np.array(d_tree.centre)
    products = q[q_centre] @ d[d_centre].T
    reach = reach_of(
        products, q_length[q_centre][:, None], q_radius[:, None], d_length[d_centre], d_radius
    )

    def floor_of(node: int) -> float:
        members = q_tree.order[q_tree.first[node] : q_tree.last[node]]
        return min(hits.floor[i] for i in members)

    def compare(a: int, b: int) -> None:
        of_q = q_tree.order[q_tree.first[a] : q_tree.last[a]]
        of_d = d_tree.order[d_tree.first[b] : d_tree.last[b]]
        scores = q_exact[of_q] @ d_exact[of_d].T
        hits.compared += scores.size
        own = queries["rows"][of_q][:, None] == data["rows"][of_d]
        floors = np.array([hits.floor[i] for i in of_q], dtype=object if scores.dtype == object else float)
        good = (scores >= floors[:, None]) & ~own
        ids, rows = data["ids"][of_d], data["rows"][of_d]
        for i in np.flatnonzero(good.any(axis=1)):
            some = np.flatnonzero(good[i])
            hits.offer(of_q[i], scores[i, some].tolist(), ids[some].tolist(), rows[some].tolist())

    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        if reach[a, b] < floor_of(a):
            continue
        q_kids, d_kids = q_tree.kids[a], d_tree.kids[b]
        if not q_kids and not d_kids:
            compare(a, b)
            continue
        wider = not d_kids or (q_kids and q_radius[a] > d_radius[b])
        pairs = [(kid, b) for kid in q_kids] if wider else [(a, kid) for kid in d_kids]
        todo.extend(sorted(pairs, key=lambda p: reach[p]))
    return hits


def _floats(column: pa.Array) -> np.ndarray:
    """Rows of binary vectors of one length as a matrix of doubles."""
    values = column.to_pylist()
    dim = len(values[0]) // 8 if values else 0
    return _matrix(b"".join(values), dim, len(values))


def _matrix(points: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(points, np.float64).reshape(n, dim)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def scaled_vectors(vectors: DataFrame, params: DualTree, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, point) of the usable rows, points as doubles that are whole numbers."""
    kept = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    kept = kept.where(_usable(F.col("v"))).withColumn("dim", F.size("v"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [
                np.floor(params.scale * np.array(v, np.float64)).tobytes() for v in batch.column(1).to_pylist()
            ]
            columns = [batch.column(0), batch.column(2), pa.array(points, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "point"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(scale, f"vec_id {kind}, dim int, point binary")


def _with_cells(points: DataFrame, params: DualTree) -> DataFrame:
    """The number of the coarse tree's leaf that each row is nearest to. The trees, one for each
    vector length among ``params.sample`` rows, are made on the driver, and their leaves' centres,
    no more than there are rows in the sample, go out with the tasks. What they are made from
    changes the cost of the search and nothing else."""
    some = points.orderBy(F.xxhash64("vec_id", F.lit(7))).limit(params.sample)
    sampled: dict[int, list[bytes]] = {}
    for dim, point in some.select("dim", "point").collect():
        sampled.setdefault(dim, []).append(bytes(point))
    centres = {
        dim: coarse_centres(_matrix(b"".join(found), dim, len(found)), params) for dim, found in sampled.items()
    }
    lengths = {dim: np.einsum("ij,ij->i", c, c) for dim, c in centres.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell = np.zeros(batch.num_rows, np.int32)
            for dim in np.intersect1d(dims, list(centres)):
                mine = np.flatnonzero(dims == dim)
                x = _floats(batch.column(2).take(pa.array(mine)))
                cell[mine] = np.argmin(lengths[dim] - 2 * (x @ centres[dim].T), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(assign, f"vec_id {kind}, dim int, point binary, cell int")


def _runs(rows: DataFrame, size: int, name: str, group: str) -> DataFrame:
    """Rows (vec_id, dim, point, row, cell) as runs of ``size`` in tree order: one row for each,
    with its members' ids, rows and points behind each other, and the ball around them."""
    keys = [F.col(c).asc() for c in ("dim", "cell", "vec_id", "row")]
    placed = numbered(rows, keys, name)
    run = F.floor(F.col("place") / size).cast("long").alias(group)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        points = _floats(table.column("point"))
        centre = points.mean(axis=0)
        columns = {
            "dim": [key[0].as_py()],
            group: [key[1].as_py()],
            "ids": [table.column("vec_id").to_pylist()],
            "rows": [table.column("row").to_pylist()],
            "points": [points.tobytes()],
            "centre": [centre.tolist()],
            "length": [float(np.sqrt(centre @ centre))],
            "radius": [float(_distances(points, centre).max())],
        }
        return pa.table(columns, schema=schema)

    schema = pa.schema(
        [
            ("dim", pa.int32()),
            (group, pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("rows", pa.list_(pa.int64())),
            ("points", pa.binary()),
            ("centre", pa.list_(pa.float64())),
            ("length", pa.float64()),
            ("radius", pa.float64()),
        ]
    )
    ddl = (
        f"dim int, {group} long, ids array<long>, rows array<long>, points binary, "
        "centre array<double>, length double, radius double"
    )
    grouped = placed.select("vec_id", "dim", "point", "row", run).groupBy("dim", group)
    return written(grouped.applyInArrow(gather, ddl), f"{name}-runs")


def _pairs(packs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every pack of queries with every block of its vector length, and how high a score between
    them can be. These are the stated queries against all rows, in blocks: the pairs are formed by
    an equi-join on a share of the blocks, to each of which the packs' outlines are copied."""
    shares = max(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    q = packs.select(
        "dim", "pack", F.col("centre").alias("q"), F.col("length").alias("ql"), F.col("radius").alias("qr"),
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
    )
    share = F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int").alias("share")
    d = blocks.select(
        "dim", "block", F.col("centre").alias("d"), F.col("length").alias("dl"), F.col("radius").alias("dr"), share
    )
    product = F.aggregate(F.zip_with("q", "d", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    joined = q.join(d, ["dim", "share"]).withColumn("product", product)
    reach = reach_of(F.col("product"), F.col("ql"), F.col("qr"), F.col("dl"), F.col("dr"))
    return joined.select("dim", "pack", "block", "product", reach.alias("reach"))


def _not_above(score: int) -> float:
    """The score as a double, of those too long for one the double below."""
    return float(score) if abs(score) < 2**53 else math.nextafter(float(score), -math.inf)


_HITS = "pack long, query_row long, vec_id long, row long, score long, floor double"
_LONG = 2**63 - 1


def _searched(pairs: DataFrame, packs: DataFrame, blocks: DataFrame, params: DualTree) -> DataFrame:
    """Hits of each pair (dim, pack, block); ``packs`` has the queries' worst scores so far. Each
    task has one pack and one block at a time."""
    keys = ["dim", "pack", "block"]
    mine, theirs = (pairs.select(*[F.col(c).alias(c) for c in keys]) for _ in range(2))
    q_side = mine.join(packs.select("dim", "pack", "rows", "points", "worst"), ["dim", "pack"])
    d_side = theirs.join(blocks.select("dim", "block", "ids", "rows", "points"), ["dim", "block"])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for a in left.itertuples():
            queries = {"rows": np.array(a.rows), "points": _matrix(a.points, a.dim, len(a.rows))}
            for b in right.itertuples():
                data = {
                    "ids": np.array(b.ids),
                    "rows": np.array(b.rows),
                    "points": _matrix(b.points, b.dim, len(b.rows)),
                }
                hits = search_pair(queries, data, list(a.worst), params)
                for row, found in zip(a.rows, hits.found):
                    for negative, vec_id, data_row in found:
                        score = -int(negative)
                        clamped = max(min(score, _LONG), -_LONG - 1)
                        rows.append((a.pack, row, vec_id, data_row, clamped, _not_above(score)))
        return pd.DataFrame(rows, columns=["pack", "query_row", "vec_id", "row", "score", "floor"])

    return q_side.groupBy(*keys).cogroup(d_side.groupBy(*keys)).applyInPandas(search, _HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query, with their rank. A query has k from each pair at most."""
    exact = -F.col("score").cast("decimal(38,0)")
    hit = F.struct((-F.col("floor")).alias("order"), exact.alias("exact"), "vec_id", "row", "score")
    best = hits.groupBy("pack", "query_row").agg(F.slice(F.sort_array(F.collect_list(hit)), 1, k).alias("hits"))
    return best.select("pack", "query_row", F.posexplode("hits").alias("at", "hit")).select(
        "pack", "query_row", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.row", "hit.score",
        (-F.col("hit.order")).alias("floor"),
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    params: DualTree = DualTree(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``is_query``, a column of the id
    under the name vec_id, holds, the ``k`` rows of highest integer inner product, all if there are
    fewer, equal scores to the smaller vec_id.

    Rows whose vector is null or holds a null or non-finite component take no part, nor do rows
    without an id; rows meet only others of their length. A zero or empty vector scores 0. A row
    that repeats an id is a row of its own, also for other rows of that id, and a repeated query
    has its own list; among equal scores of one id the order cannot be seen. Scores beyond a long
    are given as the nearest long. No query, or no other row: no rows.

    A pack first meets the ``seeds`` blocks whose centres have the highest products with its own;
    every other block is then left out only if the two outlines cannot reach the worst k-th score
    of the pack's queries. All else is compared, so the result is exact whatever the sample.
    """
    scaled = scaled_vectors(vectors, params, id_col, vector_col).where("vec_id IS NOT NULL")
    points = written(scaled, "points").withColumn("vec_id", F.col("vec_id").cast("long"))
    rows = _with_cells(points, params).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "cells")
    blocks = _runs(rows, params.block, "data", "block")
    queries = rows.where(is_query)
    packs = _runs(queries, params.pack, "queries", "pack")
    pairs = written(_pairs(packs, blocks), "pairs")

    anything = F.array_repeat(F.lit(-math.inf), F.size("rows"))
    nearest = Window.partitionBy("dim", "pack").orderBy(F.col("product").desc(), "block")
    first = pairs.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= params.seeds)
    first = written(first.select("dim", "pack", "block"), "first")
    seeded = written(_searched(first, packs.withColumn("worst", anything), blocks, params), "seeded")

    kth = _best(seeded, params.k).where(F.col("rank") == params.k)
    known = kth.groupBy("pack").agg(
        F.map_from_entries(F.collect_list(F.struct("query_row", "floor"))).alias("known")
    )
    worst = F.transform("rows", lambda r: F.coalesce(F.try_element_at("known", r), F.lit(-math.inf)))
    packs = packs.join(known, "pack", "left").withColumn("worst", worst).drop("known")
    packs = written(packs, "packs")
    least = packs.select("dim", "pack", F.array_min("worst").alias("least"))
    rest = pairs.join(first, ["dim", "pack", "block"], "left_anti").join(least, ["dim", "pack"])
    rest = rest.where(F.col("reach") >= F.col("least"))
    found = seeded.unionByName(_searched(rest, packs, blocks, params))
    best = _best(found, params.k)
    names = queries.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"))
    return best.join(names, "query_row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
