"""Connected components by alternating large-star and small-star rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import remove, shared_path


def _stored(rows: DataFrame, name: str, paths: list[str]) -> DataFrame:
    paths.append(shared_path(rows.sparkSession, name))
    rows.write.parquet(paths[-1])
    return rows.sparkSession.read.schema(rows.schema).parquet(paths[-1])


def _attach_least(pairs: DataFrame, paths: list[str]) -> DataFrame:
    """(u, v) with the least neighbour of u; u's own id counts too. The minima are written
    first: then either Spark finds them small enough to broadcast, or both sides of the join
    are plain shuffles and the pairs of a hub can be cut into several tasks."""
    least = _stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "least", paths)
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame, paths: list[str]) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = _attach_least(both, paths).where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, paths: list[str]) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _attach_least(down.where(F.col("u") != F.col("v")), paths)
    ends = F.explode(F.array("u", "v")).alias("w")
    moved = joined.select(ends, "m").where(F.col("w") != F.col("m"))
    return moved.select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge that is not itself the least of its component,
    with that least id. Nodes the result leaves out are their own component; null ends and
    loops count for nothing; an empty table gives an empty one.

    Each half round writes its edges to the shared folder, so a lost executor costs half a
    round at most, and the rounds stop when one changes nothing.
    """
    spark = edges.sparkSession
    old: list[str] = []
    state = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    state = _stored(state.where(F.col("u") != F.col("v")).distinct(), "edges", old)
    before = None
    while True:
        paths: list[str] = []
        large = _stored(_large_star(state, paths), "large-star", paths)
        state = _stored(_small_star(large, paths), "small-star", paths)
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = tuple(state.agg(F.count("*"), digest).first())
        for path in old + paths[:-1]:
            remove(spark, path)
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        old, before = paths[-1:], now
