"""Embedding near-duplicates by NN-descent, with a recall audit and exact link counts."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hashed_share, written
from shelfcast.llm.components import connected_components

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Descent:
    """Parameters of the graph, the audit and the final comparison."""

    threshold: float = 0.95
    neighbours: int = 8
    tables: int = 8  # random-projection orders the first graph is made from
    leaf: int = 128  # rows compared at once in such an order, and around a vector
    rounds: int = 8  # of refinement, at most
    still: float = 0.002  # share of changed neighbours below which refinement ends
    margin: float = 0.01  # half precision is used in the search; links are verified in double
    audit: int = 256  # queries of each kind compared with all, those least by hash of their id
    recall: float = 0.99  # wanted of the audit; below it the search goes on with longer lists
    widest: int = 32  # neighbours at most in such further searches; after them all pairs are compared
    chunk: int = 1024  # vectors of a component compared at once
    seed: int = 17


_EDGES = pa.schema([("v", pa.int64()), ("u", pa.int64()), ("sim", pa.float32())])


def _usable(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    """Rows of fixed-size binary vectors as one matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty((0, 0), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, vectors, as unit vectors in double and in half precision; the columns
    before it as they are."""
    for batch in batches:
        full, half = [], []
        for vector in batch.column(batch.num_columns - 1).to_pylist():
            v = np.array(vector, dtype=np.float64)
            v /= np.abs(v).max()  # no overflow in the squares
            v /= np.linalg.norm(v)
            full.append(v.tobytes())
            half.append(v.astype(np.float16).tobytes())
        columns = [*batch.columns[:-1], pa.array(full, pa.binary()), pa.array(half, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "full", "half"])


def _orders(params: Descent, seed: int):
    """(tree, code, place, id, component, half): each vector's place in each random order. The
    code is made of signs of projections, the place within a code is one more projection."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            matrix = _matrix(batch.column(2), np.float16).astype(np.float32)
            for tree in range(params.tables):
                if not len(matrix):
                    continue
                if tree not in planes:
                    rng = np.random.default_rng(seed + tree)
                    planes[tree] = rng.standard_normal((matrix.shape[1], 33)).astype(np.float32)
                at = matrix @ planes[tree]
                # Gray order: neighbouring codes differ in one sign.
                bits = (at[:, :32] > 0).astype(np.int64)
                bits = np.bitwise_xor.accumulate(bits, axis=1)
                code = bits @ (1 << np.arange(31, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(code), tree, np.int32)),
                        pa.array(code),
                        pa.array(at[:, 32].astype(np.float32)),
                        batch.column(0),
                        batch.column(1),
                        batch.column(2),
                    ],
                    ["tree", "code", "place", "id", "component", "half"],
                )

    return run


def _best(ids: np.ndarray, part: np.ndarray, matrix: np.ndarray, k: int, floor: np.ndarray | None = None):
    """The k nearest of each row among those of other components, above ``floor``: (v, u, sim)."""
    sims = matrix @ matrix.T
    sims[part[:, None] == part[None, :]] = -2
    k = min(k, len(ids) - 1)
    if k < 1:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.float32)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sims, near, axis=1)
    good = value > (-1.5 if floor is None else floor[:, None])
    row, _ = np.nonzero(good)
    return ids[row], ids[near[good]], value[good].astype(np.float32)


def _leaves(params: Descent, k: int):
    """Runs of ``leaf`` rows of an order, overlapping by half, compared within themselves."""

    def run(batches):
        step = params.leaf // 2
        kept = None
        tree = None

        def compare(ids, part, rows):
            v, u, s = _best(ids, part, rows, k)
            return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u), pa.array(s)], schema=_EDGES)

        for batch in batches:
            trees = batch.column(0).to_numpy()
            ids = batch.column(1).to_numpy()
            part = batch.column(2).to_numpy()
            rows = _matrix(batch.column(3), np.float16).astype(np.float32)
            for one in np.unique(trees):
                mine = trees == one
                if one != tree and kept is not None and len(kept[0]):
                    yield compare(*kept)
                    kept = None
                tree = one
                joined = (ids[mine], part[mine], rows[mine])
                if kept is not None:
                    joined = tuple(np.concatenate(pair) for pair in zip(kept, joined, strict=True))
                at = 0
                while len(joined[0]) - at >= params.leaf:
                    yield compare(*(x[at : at + params.leaf] for x in joined))
                    at += step
                kept = tuple(x[at:] for x in joined)
        if kept is not None and len(kept[0]):
            yield compare(*kept)

    return run


def _local_joins(params: Descent, k: int):
    """Neighbours of a vector, both ways, compared with each other in groups of ``leaf``; a
    pair comes out if it is nearer than the worst neighbour of its first end."""

    def run(batches):
        kept = None

        def compare(rows: pa.Table):
            at = rows["node"].to_numpy()
            ids = rows["member"].to_numpy()
            part = rows["component"].to_numpy()
            floor = rows["worst"].to_numpy()
            matrix = _matrix(rows["half"], np.float16).astype(np.float32)
            cuts = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(at)].tolist()
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for i in range(a, b, params.leaf):
                    j = min(b, i + params.leaf)
                    if j - i > 1:
                        out.append(_best(ids[i:j], part[i:j], matrix[i:j], k, floor[i:j]))
            if out:
                v, u, s = (np.concatenate(column) for column in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(u), pa.array(s)], schema=_EDGES)

        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now])
            at = kept["node"].to_numpy()
            other = np.flatnonzero(at != at[-1]) if len(at) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            if not cut and len(kept) > 64 * params.leaf:  # a hub: its groups stay whole
                cut = len(kept) // params.leaf * params.leaf
            if cut:
                yield from compare(kept.slice(0, cut))
                kept = kept.slice(cut)
        if kept is not None and len(kept):
            yield from compare(kept)

    return run


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each vector, each once."""
    once = edges.groupBy("v", "u").agg(F.max("sim").alias("sim"))
    ranked = once.withColumn(
        "rank", F.expr("row_number() over (partition by v order by sim desc, u)")
    )
    return ranked.where(F.col("rank") <= k).select("v", "u", "sim")


def neighbour_graph(
    vectors: DataFrame, params: Descent, k: int, seed: int, known: DataFrame | None = None
) -> DataFrame:
    """NN-descent over (id, component, half): a first graph from random orders, refined by
    comparing the neighbours of each vector, in either direction, with each other until little
    changes. Lists hold vectors of other components than their own; pairs ``known`` (v, u) are
    gone along as well, so that a find spreads through a component. Each round is written to
    the shared folder."""
    plain = vectors.select("id", "component", "half")
    orders = plain.mapInArrow(
        _orders(params, seed), "tree int, code long, place float, id long, component long, half binary"
    )
    orders = written(orders, "orders")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = orders.repartitionByRange(n, "tree", "code", "place").sortWithinPartitions(
        "tree", "code", "place", "id"
    )
    found = leaves.select("tree", "id", "component", "half").mapInArrow(
        _leaves(params, k), "v long, u long, sim float"
    )
    graph = written(_nearest(found, k), "neighbours")
    for _ in range(params.rounds):
        # The worst of a full list; a list with room takes any.
        worst = graph.groupBy("v").agg(F.min("sim").alias("sim"), F.count("*").alias("n"))
        worst = worst.select(
            F.col("v").alias("id"),
            F.when(F.col("n") >= k, F.col("sim")).otherwise(F.lit(-1.5)).cast("float").alias("worst"),
        )
        carried = plain.join(worst, "id", "left").fillna(-1.5, "worst")
        ways = graph.select("v", "u")
        if known is not None:
            ways = ways.unionByName(known)
        pairs = ways.select(F.col("v").alias("node"), F.col("u").alias("member"))
        back = ways.select(F.col("u").alias("node"), F.col("v").alias("member"))
        own = plain.select(F.col("id").alias("node"), F.col("id").alias("member"))
        pairs = pairs.unionByName(back).distinct().unionByName(own)
        members = pairs.join(carried, pairs["member"] == carried["id"]).drop("id")
        grouped = members.repartition("node").sortWithinPartitions("node", "member")
        nearer = grouped.select("node", "member", "component", "worst", "half").mapInArrow(
            _local_joins(params, k), "v long, u long, sim float"
        )
        new = written(_nearest(graph.unionByName(nearer), k), "neighbours")
        changed = new.join(graph, ["v", "u"], "left_anti").count()
        total = new.count()
        graph = new
        if changed <= params.still * total:
            break
    return graph


def _dot(a: str, b: str):
    def run(batches):
        for batch in batches:
            x, y = (_matrix(batch.column(i), np.float64) for i in (2, 3))
            sim = np.einsum("ij,ij->i", x, y) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sim)], [a, b, "sim"]
            )

    return run


def _verified(graph: DataFrame, vectors: DataFrame, params: Descent) -> DataFrame:
    """(v, u) of the graph whose cosine in double reaches the threshold."""
    likely = graph.where(F.col("sim") >= params.threshold - params.margin)
    pairs = likely.select(F.least("v", "u").alias("v"), F.greatest("v", "u").alias("u")).distinct()
    one = vectors.select(F.col("id").alias("v"), F.col("full").alias("x"))
    two = vectors.select(F.col("id").alias("u"), F.col("full").alias("y"))
    both = pairs.join(one, "v").join(two, "u").select("v", "u", "x", "y")
    sims = both.mapInArrow(_dot("v", "u"), "v long, u long, sim double")
    return sims.where(F.col("sim") >= params.threshold).select("v", "u")


def _counter(params: Descent):
    """Rows (component, i, j, side, id, n, full), sorted: for each pair of chunks, how many
    vectors each row links to on the other side."""

    def run(batches):
        kept = None

        def count(rows: pa.Table):
            side = rows["side"].to_numpy()
            ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
            matrix = _matrix(rows["full"], np.float64)
            key = [rows[c].to_numpy() for c in ("component", "i", "j")]
            new = np.zeros(len(ids), dtype=bool)
            for part in key:
                new[1:] |= part[1:] != part[:-1]
            cuts = np.r_[0, np.flatnonzero(new), len(ids)].tolist()
            out_id, out_n = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if key[1][a] == key[2][a]:  # a chunk with itself
                    near = matrix[a:b] @ matrix[a:b].T >= params.threshold
                    np.fill_diagonal(near, False)
                    out_id.append(ids[a:b])
                    out_n.append(near @ n[a:b])
                    continue
                x, y = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                near = matrix[x] @ matrix[y].T >= params.threshold
                out_id += [ids[x], ids[y]]
                out_n += [near @ n[y], n[x] @ near]
            ids, n = np.concatenate(out_id), np.concatenate(out_n).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "linked"])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now])
            key = [kept[c].to_numpy() for c in ("component", "i", "j")]
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key])) if len(kept) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield count(kept.slice(0, cut))
                kept = kept.slice(cut)
        if kept is not None and len(kept):
            yield count(kept)

    return run


def _link_counts(members: DataFrame, params: Descent) -> DataFrame:
    """(id, linked): for each vector of a component of (component, size, id, n, full), the number of
    rows its links within the component stand for. This is the list of neighbours enlarged to
    the whole component, kept as a count: chunks of about ``chunk`` vectors meet in pairs, so
    neither a task nor a row grows with the component."""
    rows = members.withColumn("chunks", F.ceil(F.col("size") / params.chunk).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "component",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "id",
        "n",
        "full",
    )
    rows = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "id")
    counted = rows.mapInArrow(_counter(params), "id long, linked long")
    return counted.groupBy("id").agg(F.sum("linked").alias("linked"))


def _crosser(params: Descent):
    """Rows (i, j, side, id, component, full), sorted: for each pair of chunks, one link for
    each two components that link there."""

    def run(batches):
        kept = None

        def cross(rows: pa.Table):
            side, ids, part = (rows[c].to_numpy() for c in ("side", "id", "component"))
            matrix = _matrix(rows["full"], np.float64)
            i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
            cuts = np.r_[0, np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0)) + 1, len(ids)].tolist()
            out = [np.empty((0, 2), np.int64)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                x = y = np.arange(a, b)
                if i[a] != j[a]:
                    x, y = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                near = matrix[x] @ matrix[y].T >= params.threshold
                one, two = np.nonzero(near & (part[x][:, None] != part[y][None, :]))
                one, two = x[one], y[two]
                _, first = np.unique(np.c_[part[one], part[two]], axis=0, return_index=True)
                out.append(np.c_[ids[one[first]], ids[two[first]]])
            v, u = np.concatenate(out).T
            return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u)], ["v", "u"])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now])
            i, j = kept["i"].to_numpy(), kept["j"].to_numpy()
            other = np.flatnonzero((i != i[-1]) | (j != j[-1])) if len(kept) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield cross(kept.slice(0, cut))
                kept = kept.slice(cut)
        if kept is not None and len(kept):
            yield cross(kept)

    return run


def links_between(vectors: DataFrame, params: Descent) -> DataFrame:
    """(v, u): links between the components of (id, component, full), at least one for each two
    components that link. Every pair is compared, in chunks of about ``chunk`` vectors: the work
    grows with the square of the table, and nothing is missed."""
    chunks = max(1, -(-vectors.count() // params.chunk))
    rows = vectors.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select(
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "id",
        "component",
        "full",
    )
    rows = rows.repartition("i", "j").sortWithinPartitions("i", "j", "id")
    return rows.mapInArrow(_crosser(params), "v long, u long").distinct()


def _audit_counts(shared, threshold: float):
    def run(batches):
        ids, queries = shared.value
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            matrix = _matrix(batch.column(2), np.float64)
            if not len(matrix):
                continue
            n = batch.column(1).to_numpy()
            for at in range(0, len(matrix), 4096):
                near = queries @ matrix[at : at + 4096].T >= threshold
                total += near @ n[at : at + 4096]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "linked"])

    return run


def audit_recall(vectors: DataFrame, counts: DataFrame, params: Descent) -> tuple[float, int]:
    """Least of two shares, and the number of audited vectors with links: of the links of a
    vector, the share that ``counts`` (id, linked) holds, as the mean over vectors that have
    any, for those in components of more than ``audit`` vectors and for all others.

    Queries are taken from (id, component, n, full) by the size of component they were given:
    ``audit`` each of those alone, of those in smaller and of those in larger components. So as
    many have links outside large components as were found there, up to ``audit``, and a hot
    group decides only on its own share. Vectors alone and in smaller components are weighed by
    how many there are. The queries, compared with all vectors, are a bounded number; the work
    grows with the table alone."""
    spark = vectors.sparkSession
    sizes = vectors.groupBy("component").agg(F.count("*").alias("size"))
    kind = F.when(F.col("size") == 1, 0).when(F.col("size") <= params.audit, 1).otherwise(2)
    kinds = sizes.select("component", kind.alias("kind"), "size")
    numbers = {r["kind"]: r["n"] for r in kinds.groupBy("kind").agg(F.sum("size").alias("n")).collect()}
    rows = []
    for one, number in sorted(numbers.items()):
        share = vectors.where(hashed_share(F.col("id"), params.audit, number))
        share = share.join(kinds.where(F.col("kind") == one), "component")
        queries = share.select("id", "kind", "full").orderBy(F.xxhash64("id"), "id").limit(params.audit)
        rows += queries.collect()
    if not rows:
        return 1.0, 0
    ids = np.array([r["id"] for r in rows])
    matrix = np.frombuffer(b"".join(bytes(r["full"]) for r in rows), np.float64).reshape(len(ids), -1)
    shared = spark.sparkContext.broadcast((ids, matrix))
    true = vectors.select("id", "n", "full").mapInArrow(
        _audit_counts(shared, params.threshold), "id long, linked long"
    )
    true = true.groupBy("id").agg(F.sum("linked").alias("true"))  # its own rows included
    found = true.join(counts, "id", "left").join(vectors.select("id", "n"), "id")
    real = F.col("true") - F.col("n")
    got = F.least(F.coalesce("linked", F.lit(0)), real)
    shares = {r["id"]: r["share"] for r in found.where(real > 0).select("id", (got / real).alias("share")).collect()}
    asked, linked, held = np.zeros(3), np.zeros(3), np.zeros(3)
    for row in rows:
        asked[row["kind"]] += 1
        if row["id"] in shares:
            linked[row["kind"]] += 1
            held[row["kind"]] += shares[row["id"]]
    weight = np.array([numbers.get(k, 0) for k in range(3)]) / np.maximum(asked, 1)
    recalls = [
        float(weight[of] @ held[of] / (weight[of] @ linked[of]))
        for of in (slice(0, 2), slice(2, 3))
        if linked[of].any()
    ]
    return min(recalls, default=1.0), int(linked.sum())


def embedding_links(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: Descent = Descent()
) -> DataFrame:
    """vec_id, n_links, component_id of every row by cosine, whatever its other columns.

    Equal vectors are one row of the search that stands for n. Vectors that are null, empty,
    zero or hold a null or a number that is not finite link with nothing, nor do vectors of
    different lengths with each other: each length is searched by itself. Links found by the
    search are verified in double. A list full of links
    says nothing of those beyond it, so the search is done again for neighbours in other
    components, from other random orders, until it finds no link more. Within the components
    every pair is compared, so the counts hold all links of a component; what is left to miss
    is a link between two components that no list was too short for, which the audit measures
    against brute force. While that finds too few, lists get twice as long, and after
    ``widest`` all pairs are compared. Each
    row is a vector of its own, one row of the result: rows that repeat an id, with the same or
    another vector, are linked by their vectors alone. Rows with a null id link with nothing and
    have a null component; an empty table gives an empty result.
    """
    rows = table.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(7), F.col("vector")).alias("h2")]
    good = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    distinct = good.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    # Numbered in the order of their ids, so the least node of a component has its least id.
    distinct = distinct.repartitionByRange("rep").sortWithinPartitions("rep")
    distinct = distinct.select(F.monotonically_increasing_id().alias("id"), "n", "rep", *key, "vector")
    packed = distinct.mapInArrow(
        _pack, "id long, n long, rep long, h1 long, h2 long, full binary, half binary"
    )
    stored = written(packed, "vectors")
    vectors = stored.select("id", "n", "full", "half")
    lengths = [r[0] for r in vectors.select(F.octet_length("half")).distinct().collect()]
    results = [_one_length(vectors.where(F.octet_length("half") == n), params) for n in lengths]
    classes = None
    for one in results:
        classes = one if classes is None else classes.unionByName(one)
    if classes is None:
        classes = table.sparkSession.createDataFrame([], "node long, linked long, component long")
    first = stored.select(F.col("id").alias("component"), F.col("rep").alias("component_id"))
    nodes = stored.select(F.col("id").alias("node"), "rep", "h1", "h2", "n")
    nodes = nodes.join(classes.join(first, "component"), "node", "left").select(
        "h1",
        "h2",
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    found = good.select("id", *key).join(written(nodes, "nodes"), ["h1", "h2"])
    bad = rows.where(F.col("id").isNull() | ~F.coalesce(_usable(F.col("vector")), F.lit(False)))
    alone = bad.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.select("id", "n_links", "component_id").unionByName(alone).withColumnRenamed("id", "vec_id")


def _one_length(vectors: DataFrame, params: Descent) -> DataFrame:
    """(node, linked, component) of the distinct vectors that link with another."""
    k, searches = params.neighbours, 0
    labelled = vectors.withColumn("component", F.col("id"))
    known = merged = None
    while True:
        graph = neighbour_graph(labelled, params, k, params.seed + searches * params.tables, known)
        links = written(_verified(graph, vectors, params), "links")
        found = links.count()
        known = (graph.select("v", "u") if known is None else known).unionByName(links)
        searches += 1
        if found:
            labelled, merged = _merged(vectors, links, merged)
        _log.info("search %d, %d neighbours: %d links between components", searches, k, found)
        if found or searches == 1:  # until a search with orders of its own finds nothing
            continue
        counts = _counted(labelled, params)
        recall, audited = audit_recall(labelled, counts, params)
        _log.info("%d neighbours: recall %.4f, %d audited vectors with links", k, recall, audited)
        if recall >= params.recall:
            break
        if 2 * k > params.widest:
            _log.warning("recall %.4f with %d neighbours: comparing all vectors", recall, k)
            labelled, _ = _merged(vectors, links_between(labelled, params), merged)
            counts = _counted(labelled, params)
            break
        k *= 2
    return counts.join(labelled.select("id", "component"), "id").select(
        F.col("id").alias("node"), "linked", "component"
    )


def _merged(vectors: DataFrame, links: DataFrame, before: DataFrame | None):
    """The vectors with the components that ``links`` make of those ``before``, and these as
    (v, u) edges."""
    edges = links if before is None else links.unionByName(before)
    parts = written(connected_components(edges, "v", "u"), "parts")
    named = vectors.join(parts.withColumnRenamed("node", "id"), "id", "left")
    labelled = named.withColumn("component", F.coalesce("component", "id"))
    return written(labelled, "labelled"), parts.select(F.col("node").alias("v"), F.col("component").alias("u"))


def _counted(labelled: DataFrame, params: Descent) -> DataFrame:
    """(id, linked) of the vectors in components of two or more."""
    sizes = labelled.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    # Written first, so that adaptive execution can cut the join where a component is large.
    members = labelled.join(written(sizes, "sizes"), "component")
    return written(_link_counts(members.select("component", "size", "id", "n", "full"), params), "counts")
