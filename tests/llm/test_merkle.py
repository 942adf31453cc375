"""The manifest against a tree in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod, written
from shelfcast.llm.merkle import Tree, build_manifest, document_leaves


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    fields = list(row)
    if lowered and fields[4] is not None:
        fields[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in fields[4])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree_of(nodes, fan):
    """Root, and for each node the siblings left and right of it and those above it."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for first in range(0, len(nodes), fan):
            run = nodes[first : first + fan]
            for k in range(len(run)):
                for i in under[first + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            over.append([i for k in range(len(run)) for i in under[first + k]])
        nodes, under = up, over
    return nodes[0], paths


def brute(rows, fan):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        mine = [r for r in rows if r[2] == g]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = mine, *tree_of([leaf(r) for r in mine], fan)
    if not langs:
        return []
    root, tops = tree_of([trees[g][1] for g in langs], fan)
    found = []
    for g, top in zip(langs, tops):
        mine, subroot, paths = trees[g]
        for row, path in zip(mine, paths):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf(row, lowered=bad)
            for left, right in path + top:
                node = h(left + node + right)
            proof = "".join(left + right for left, right in path + top)
            found.append((row[0], leaf(row), subroot, root, proof, node))
    return sorted(found, key=str)


def manifest(spark, rows, tree=Tree()):
    schema = "doc_id long, source string, lang string, n_chars long, text string, node int, g string, block int"
    docs = spark.createDataFrame([(*r, 1, "g", 2) for r in rows], schema)
    leaves = written(document_leaves(docs, crc_mod(F.col("doc_id"), 3) == 0), "leaves")
    proofs = build_manifest(leaves, ["doc_id"], tree).proofs({"folded": "claim"})
    got = proofs.select("doc_id", "node", "subroot", "root", "proof", "folded")
    return sorted(map(tuple, got.collect()), key=str)


def rows_of(n, langs, start=0):
    return [(start + i, f"s{i % 3}", langs[i % len(langs)], i, f"Text Number {i} É") for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_group(spark, n):
    rows = rows_of(n, ["en"])
    assert manifest(spark, rows, Tree(8, 2)) == brute(rows, 8)


def test_many_groups_of_all_sizes_and_deep_trees(spark):
    rows = rows_of(95, ["en"]) + rows_of(3, ["de", None], 200) + rows_of(17, ["é"], 300)
    rows += [(400 + i, None, f"l{i}", None, None) for i in range(12)]
    assert manifest(spark, rows, Tree(2, 2)) == brute(rows, 2)


def test_odd_rows(spark):
    rows = rows_of(20, ["en", None])
    rows += [(None, None, None, None, None), (None, None, None, None, ""), (3, "x", "en", 5, "A" * 300_000)]
    rows += [rows[4]] * 9 + [(4, "other", "en", 0, "Same id"), (21, "", "", 0, "empty language")]
    got = manifest(spark, rows)
    assert got == brute(rows, 8) and len(got) == len(rows)
    roots = {r[3] for r in got}
    for doc_id, node, _, root, _, folded in got:
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        text = next(r[4] for r in rows if leaf(r) == node)
        changed = bad and text is not None and text.lower() != text
        assert (folded == root) != bool(changed)
    assert len(roots) == 1


def test_empty_table(spark):
    assert manifest(spark, []) == []


def test_a_large_group_is_many_blocks(spark):
    """More blocks than one level of blocks holds; order and partitions do not matter."""
    rows = rows_of(600, ["en"]) + rows_of(5, ["de"], 900)
    got = manifest(spark, rows[::-1], Tree(4, 2))
    assert got == brute(rows, 4)
