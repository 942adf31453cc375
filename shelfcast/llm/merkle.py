"""A Merkle manifest of a dataset: a tree for each group of rows, one over the groups, proofs.

A node is the SHA-256, as 64 hex digits, of what is under it. The nodes of one level that lie
under a block stand behind each other in one string, so a parent is the hash of a substring of
fixed width and the siblings of a node are the substrings to its left and right.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, written
from shelfcast.llm.ordering import numbered

DIGEST = 64  # hex digits of a node


@dataclass(frozen=True)
class Tree:
    """Shape of the tree: children of a node, and levels of a block that one row holds. A block
    is a whole subtree of ``fan ** levels`` places, so its strings have a fixed greatest length."""

    fan: int = 8
    levels: int = 3

    @property
    def block(self) -> int:
        return self.fan**self.levels


def field_text(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else UTF-8 length, colon, value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """The leaf of a row: the hash of its values, each with its length, one behind the other."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def _bytes(text: Column) -> Column:
    """Hex digits as bytes: Spark cuts those at once, and counts through a string."""
    return text.cast("binary")


def _substring(level: Column, first: Column, n: Column) -> Column:
    """``n`` nodes of a level from the one numbered ``first``."""
    return F.substring(level, first * DIGEST + 1, n * DIGEST)


def _above(level: Column, tree: Tree) -> Column:
    """The next level: the hash of each run of ``fan`` nodes, the last run being what is left."""
    n = F.octet_length(level).cast("int")
    runs = F.sequence(F.lit(0), F.ceil(n / (tree.fan * DIGEST)).cast("int") - 1)
    return _bytes(
        F.array_join(
            F.transform(runs, lambda r: F.sha2(_substring(level, r * tree.fan, F.lit(tree.fan)), 256)), ""
        )
    )


def _height(n: Column, tree: Tree) -> Column:
    """Levels that a block climbs: up to the group's root if the block holds the whole group,
    else all of its own."""
    height = F.lit(tree.levels)
    for h in reversed(range(tree.levels)):
        height = F.when(n <= tree.fan**h, F.lit(h)).otherwise(height)
    return height


def _siblings(slot: Column, levels: list[str], height: Column, tree: Tree) -> Column:
    """What stands to the left and right of a node and of the nodes above it in their runs."""
    steps = []
    for h, level in enumerate(levels):
        own = F.floor(slot / tree.fan**h).cast("int")
        first = F.floor(slot / tree.fan ** (h + 1)).cast("int") * tree.fan
        left = _substring(F.col(level), first, own - first)
        right = _substring(F.col(level), own + 1, first + tree.fan - 1 - own)
        steps.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*steps), F.lit(1), height)


def _fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(
        path,
        node,
        lambda acc, step: F.sha2(F.concat(step["left"], _bytes(acc), step["right"]), 256),
    )


def _path_text(path: Column) -> Column:
    return F.aggregate(
        path, _bytes(F.lit("")), lambda acc, step: F.concat(acc, step["left"], step["right"])
    )


_NO_PATH = "CAST(array() AS array<struct<left: binary, right: binary>>)"


def _blocks(nodes: DataFrame, tree: Tree, name: str) -> DataFrame:
    """Nodes (g, place, n, node, and others) as one row for each block of their group: its
    members by slot, its levels as strings, its height, its root."""
    members = [c for c in nodes.columns if c not in ("g", "place", "n")]
    slot = F.pmod("place", F.lit(tree.block)).cast("int").alias("slot")
    block = F.floor(F.col("place") / tree.block).cast("long").alias("block")
    grouped = nodes.groupBy("g", block, "n").agg(
        F.sort_array(F.collect_list(F.struct(slot, *members))).alias("members")
    )
    levels = grouped.withColumn("level_0", _bytes(F.array_join("members.node", "")))
    for h in range(tree.levels):
        levels = levels.withColumn(f"level_{h + 1}", _above(F.col(f"level_{h}"), tree))
    height = _height(F.col("n"), tree)
    tops = F.array(*[F.substring(f"level_{h}", 1, DIGEST).cast("string") for h in range(tree.levels + 1)])
    with_height = levels.withColumn("height", height).withColumn("top", F.get(tops, F.col("height")))
    return written(with_height.drop(f"level_{tree.levels}"), name)


def _paths(blocks: DataFrame, above: DataFrame, tree: Tree) -> DataFrame:
    """For each member of the blocks its group, place and whole path, ``above`` having (g, block,
    path, ...) of each block's root."""
    levels = [f"level_{h}" for h in range(tree.levels)]
    extra = [c for c in above.columns if c not in ("g", "block", "path")]
    joined = _under(blocks, above)
    found = F.transform(
        "members",
        lambda m: F.struct(
            m["slot"].alias("slot"),
            F.concat(_siblings(m["slot"], levels, F.col("height"), tree), F.col("path")).alias("path"),
        ),
    )
    exploded = joined.select("g", "block", F.explode(found).alias("m"), *extra)
    place = F.col("block") * tree.block + F.col("m.slot")
    return exploded.select("g", place.alias("block"), F.col("m.path").alias("path"), *extra)


def _under(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with what is known of their roots."""
    named = above.withColumnsRenamed({"g": "_g", "block": "_block"})
    same = F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_block"))
    return blocks.join(named, same).drop("_g", "_block")


def _climb(nodes: DataFrame, tree: Tree, name: str) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks' roots, and so on, until every group is one
    block. Each step has ``tree.block`` times fewer rows."""
    steps = [_blocks(nodes, tree, f"{name}-0")]
    while not steps[-1].where("block > 0").isEmpty():
        below = steps[-1]
        n = F.ceil(F.col("n") / tree.block).cast("long").alias("n")
        up = below.select("g", F.col("block").alias("place"), n, F.col("top").alias("node"))
        steps.append(_blocks(up, tree, f"{name}-{len(steps)}"))
    return steps


def _descend(steps: list[DataFrame], tree: Tree, above: DataFrame) -> DataFrame:
    """(g, block, path, ...) of the lowest blocks, from those of the groups' own roots."""
    for blocks in reversed(steps[1:]):
        above = _paths(blocks, above, tree)
    return above


@dataclass(frozen=True)
class Manifest:
    """A written tree over a dataset. ``blocks`` holds the rows' leaves with their levels,
    ``paths`` for each block the siblings from its root to the dataset's, with subroot and root."""

    tree: Tree
    blocks: DataFrame
    paths: DataFrame

    def proofs(self, claims: dict[str, str]) -> DataFrame:
        """One row for each leaf: its columns, its subroot, the root, ``proof``, which is its
        siblings' digests from the leaf upwards, left to right, and for each claim the root that
        a column of the rows, taken for the leaf, leads to with these siblings. A null claim is
        the leaf itself."""
        levels = [f"level_{h}" for h in range(self.tree.levels)]
        joined = _under(self.blocks, self.paths)

        def proved(m):
            path = F.concat(_siblings(m["slot"], levels, F.col("height"), self.tree), F.col("path"))
            claimed = {name: F.coalesce(m[column], m["node"]) for name, column in claims.items()}
            folded = [_fold(node, path).alias(name) for name, node in claimed.items()]
            return F.struct(m.alias("row"), _path_text(path).cast("string").alias("proof"), *folded)

        rows = joined.select(
            F.col("g"), "subroot", "root", F.explode(F.transform("members", proved)).alias("p")
        )
        names = [f.name for f in self.blocks.schema["members"].dataType.elementType if f.name != "slot"]
        return rows.select(
            "g", *[F.col(f"p.row.{c}").alias(c) for c in names], "subroot", "root", "p.proof",
            *[f"p.{name}" for name in claims],
        )


def build_manifest(leaves: DataFrame, order: list[str], tree: Tree = Tree()) -> Manifest:
    """The tree of written leaves: ``g`` names a row's group, ``node`` is its leaf, ``order`` the
    columns that a group's leaves ascend by; other columns go along to the proofs.

    A group's root is reached when one node is left, so a lone leaf is its own root. The groups'
    roots, ordered by name (null first, then by UTF-8 bytes), are leaves of one more tree.
    Rows that agree in the order follow by leaf, so that repeated rows give one tree whatever
    their partitions. Places come from a range shuffle; a block has ``tree.block`` leaves at
    most, however large its group is. No rows, no blocks.
    """
    keys = [F.col("g").asc(), *[F.col(c).asc() for c in order], F.col("node").asc()]
    placed = numbered(leaves, keys, "leaves")
    groups = placed.groupBy("g").agg(F.min("place").alias("_first"), F.count("*").alias("n"))
    groups = written(groups.withColumnRenamed("g", "_g"), "groups")
    nodes = placed.join(groups, F.col("g").eqNullSafe(F.col("_g")))
    nodes = nodes.withColumn("place", F.col("place") - F.col("_first")).drop("_first", "_g")
    steps = _climb(nodes, tree, "blocks")
    subroots = steps[-1].where("block = 0").select("g", F.col("top").alias("subroot"))
    heads = numbered(subroots, [F.col("g").asc()], "subroots")
    n_groups = F.lit(groups.count())
    over = _climb(
        heads.select(F.lit(True).alias("g"), "place", n_groups.alias("n"), F.col("subroot").alias("node")),
        tree,
        "heads",
    )
    top = over[-1].select(
        "g", F.lit(0).cast("long").alias("block"), F.expr(_NO_PATH).alias("path"), F.col("top").alias("root")
    )
    head_paths = _descend([None, *over], tree, top)
    head_paths = head_paths.select(F.col("block").alias("_place"), "path", "root")
    tops = heads.join(head_paths, F.col("place") == F.col("_place")).select(
        "g", F.lit(0).cast("long").alias("block"), "path", "subroot", "root"
    )
    paths = written(_descend(steps, tree, tops), "paths")
    return Manifest(tree, steps[0], paths)


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """The leaves of a table of documents: group, id, the leaf, and as ``claim`` the leaf that the
    row has with the letters A-Z of its text lowered, where ``tampered`` holds, else null. Null ids come first, and are
    leaves like others; so are null and empty texts, which differ."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = docs.select(*columns, F.coalesce(tampered, F.lit(False)).alias("_tampered"))
    changed = F.when(F.col("_tampered"), leaf_hash([*map(F.col, columns[:-1]), ascii_lower(F.col("text"))]))
    leaf = leaf_hash([F.col(c) for c in columns])
    return rows.select(
        F.col("lang").alias("g"), "doc_id", leaf.alias("node"), changed.alias("claim")
    )
