"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import UPPER, one_text, written
from shelfcast.llm.components import connected_components

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
BITS = 64
HOT = 4096  # rows of one block compared in one go; larger blocks are cut into chunk pairs


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the word shingles of one text; 0 without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        pieces = [joined]
    else:
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        ends = (starts[shingle:] - 1).tolist()
        pieces = [joined[i:j] for i, j in zip(starts[: len(ends)].tolist(), ends, strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), ">u8", len(pieces))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # whole text, in bounded memory
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([fingerprint(t, shingle, seed) for t in batch], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return of(text)


def _widths(blocks: int) -> list[int]:
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def block_keys(fp: Column, distance: int, blocks: int) -> Column:
    """Array of keys, one for each choice of blocks - distance blocks: two fingerprints within
    the distance differ in at most that many blocks, so they agree on at least one choice."""
    if not 0 <= distance < blocks:
        raise ValueError("there must be more blocks than differing bits")
    widths, shift, parts = _widths(blocks), 0, []
    for width in widths:
        mask = F.lit((1 << width) - 1).cast("long")
        parts.append(F.shiftrightunsigned(fp, shift).bitwiseAND(mask))
        shift += width
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        if sum(widths[i] for i in chosen) > 50:
            raise ValueError("too many blocks: a key has to fit 50 bits")
        key = F.lit(n).cast("long")
        for i in chosen:
            key = F.shiftleft(key, widths[i]).bitwiseOR(parts[i])
        keys.append(key)
    return F.array(*keys)


def _relabel(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row reachable, given the links (a, b) on top of the labels so far."""
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(new, end, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def link_rows(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by group: links each row to the first row of its group it is connected to
    by steps within the distance. One link a row at most, however dense a group is."""
    n = len(fp)
    label = np.arange(n)
    active, offset, wait_a, wait_b, waiting = np.arange(n), 0, [], [], 0
    while True:
        offset += 1
        active = active[active + offset < n]
        active = active[group[active] == group[active + offset]]
        if not len(active):
            break
        near = np.bitwise_count(fp[active] ^ fp[active + offset]) <= distance
        a = active[near]
        b = a + offset
        apart = label[a] != label[b]
        if apart.any():
            wait_a.append(a[apart])
            wait_b.append(b[apart])
            waiting += len(wait_a[-1])
        if waiting > 100_000:
            label = _relabel(label, np.concatenate(wait_a), np.concatenate(wait_b))
            wait_a, wait_b, waiting = [], [], 0
    if waiting:
        label = _relabel(label, np.concatenate(wait_a), np.concatenate(wait_b))
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _linker(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: pa.Table) -> pa.RecordBatch:
            key = [rows[c].to_numpy() for c in ("key", "i", "j")]
            fp = rows["fp"].to_numpy()
            new = np.zeros(len(fp), dtype=bool)
            for k in key:
                new[1:] |= k[1:] != k[:-1]
            a, b = link_rows(np.cumsum(new), fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

        kept = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now])
            if len(kept) < 1 << 16:
                continue
            key = [kept[c].to_numpy() for c in ("key", "i", "j")]
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on
            if cut:
                yield links(kept.slice(0, cut))
                kept = kept.slice(cut).combine_chunks()
        if kept is not None and len(kept):
            yield links(kept)

    return run


def linked_fingerprints(fps: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """(a, b): links that connect the distinct values of ``fp`` within the distance. Not every
    pair within it: a group of n linked values gives n - 1 links for each block they share.

    Blocks of one row are left out before Python. A block of more than HOT rows is cut into
    chunks, and each pair of chunks is compared as a group of its own, so no task holds a
    whole block. More ``blocks`` mean longer keys and fewer chance meetings, for more rows:
    6 for some ten million values, 7 or 8 beyond. The result connects the same values.
    """
    keys = fps.select("fp", F.explode(block_keys(F.col("fp"), distance, blocks)).alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    cut = sizes.select("key", F.ceil(F.col("n") / HOT).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = keys.join(cut, "key").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.withColumn("other", other).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    return rows.mapInArrow(_linker(distance), "a long, b long").distinct()


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = 4,
    shingle: int = 4,
    seed: int = 42,
    blocks: int = 6,
) -> DataFrame:
    """doc_id, fp (signed 64-bit), component_id: least doc_id connected by fingerprints that
    differ in at most ``distance`` bits.

    Copies share one fingerprint and meet as one row, so a group of any size costs one row in
    the search. Null and empty texts have fingerprint 0 and link like any other. Rows with a
    null id take part in no group and keep a null component. Repeated rows give repeated
    results; other columns are not read; an empty table gives an empty result.
    """
    source = one_text(docs, id_col, text_col)
    prints = source.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        fingerprint_column(F.col("text"), shingle, seed).alias("fp"),
    )
    prints = written(prints, "fingerprints")
    known = prints.where(F.col("doc_id").isNotNull())
    distinct = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = connected_components(linked_fingerprints(distinct.select("fp"), distance, blocks))
    named = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id")
    group = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return prints.join(by_fp, "fp", "left").select("doc_id", "fp", group.alias("component_id"))
