"""Importance resampling towards a target distribution, over hashed word n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import one_text, written
from shelfcast.llm.ordering import numbered


@dataclass(frozen=True)
class Resampling:
    """What a feature is, how it is weighed and how much is drawn."""

    buckets: int = 10_000  # crc32 of a feature, modulo this
    longest: int = 3  # words of the longest feature
    min_words: int = 20  # shorter documents are weighed, not drawn
    percent: int = 5  # of the documents that are long enough
    seed: int = 42  # of the noise that makes the highest scores a sample
    scale: int = 1000  # weights are whole numbers of this part
    chunk: int = 1 << 13  # words whose features share one table
    piece: int = 1 << 20  # bytes of texts whose words are found at once, if not one text is longer


# Bytes of a word are 0-9, a-z and all beyond ASCII, after A-Z have been lowered.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

# The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(11400714785074694791),
    np.uint64(14029467366897019727),
    np.uint64(1609587929392839161),
    np.uint64(9650029242287828579),
    np.uint64(2870177450012600261),
)
_LOW32 = np.uint64(0xFFFFFFFF)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _mixed(acc, lane):
    return _turn(acc + lane * _P2, 31) * _P1


def eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of a buffer on, as one number; places from the last
    seven on see zeros behind the end."""
    padded = np.zeros(len(buffer) + 8, np.uint8)
    padded[: len(buffer)] = buffer
    return np.ascontiguousarray(np.ndarray((len(buffer) + 1,), "<u8", padded, 0, (1,)))


def xxhash64_spans(eight: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of the byte spans of a buffer, given by its ``eights``, all at once."""
    with np.errstate(over="ignore"):
        state = np.full(len(at), _P5, np.uint64)
        wide = np.flatnonzero(size >= 32)
        if len(wide):
            state[wide] = _striped(eight, at[wide], size[wide])
        state += size.astype(np.uint64)
        place, left = at + (size & ~31), size & 31
        for k in range(3):
            some = np.flatnonzero(left >= 8 * (k + 1))
            lane = _mixed(np.uint64(0), eight[place[some] + 8 * k])
            state[some] = _turn(state[some] ^ lane, 27) * _P1 + _P4
        some = np.flatnonzero(left & 4)
        lane = (eight[place[some] + (left[some] & 24)] & _LOW32) * _P1
        state[some] = _turn(state[some] ^ lane, 23) * _P2 + _P3
        for k in range(3):
            some = np.flatnonzero((left & 3) > k)
            lane = (eight[place[some] + (left[some] & 28) + k] & np.uint64(0xFF)) * _P5
            state[some] = _turn(state[some] ^ lane, 11) * _P1
        state = (state ^ (state >> np.uint64(33))) * _P2
        state = (state ^ (state >> np.uint64(29))) * _P3
        return state ^ (state >> np.uint64(32))


def _striped(eight: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The state of XXH64 after the whole 32-byte stripes of spans that have one."""
    first = (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)
    lanes = [np.full(len(at), v, np.uint64) for v in first]
    stripes = size >> 5
    going, n = np.arange(len(at)), 0
    while len(going):
        for k, lane in enumerate(lanes):
            lane[going] = _mixed(lane[going], eight[at[going] + 32 * n + 8 * k])
        n += 1
        going = going[stripes[going] > n]
    state = sum((_turn(v, s) for v, s in zip(lanes[1:], (7, 12, 18))), _turn(lanes[0], 1))
    for lane in lanes:
        state = (state ^ _mixed(np.uint64(0), lane)) * _P1 + _P4
    return state


def _same_bytes(eight, at, other, size) -> np.ndarray:
    """Whether pairs of spans of one size hold the same bytes."""
    same = np.ones(len(at), bool)
    going, k = np.flatnonzero(at != other), 0
    while len(going):
        differ = eight[at[going] + k] ^ eight[other[going] + k]
        rest = np.minimum(size[going] - k, 8).astype(np.uint64)
        differ <<= (np.uint64(8) - rest) * np.uint64(8)  # bytes behind the span do not count
        same[going] = differ == 0
        k += 8
        going = going[same[going] & (size[going] > k)]
    return same


class FeatureTable:
    """The distinct spans of one chunk in an open-addressed table with linear probing, at most
    half full: the key of a slot is the XXH64 of its span, spans of one key are told apart by
    their bytes, and a slot has its span's bucket and count. ``slots`` names the slot of each
    span given."""

    def __init__(self, buffer: np.ndarray, at: np.ndarray, size: np.ndarray, buckets: int):
        eight = eights(buffer)
        key = xxhash64_spans(eight, at, size)
        room = 1 << max(2 * len(at) - 1, 1).bit_length()
        owner = np.full(room, -1, np.int64)
        self.slots = np.empty(len(at), np.int64)
        left = np.arange(len(at))
        probe = (key & np.uint64(room - 1)).astype(np.int64)
        while len(left):
            free = owner[probe] < 0
            owner[probe[free]] = left[free]  # of several spans the last one takes the slot
            held = owner[probe]
            hit = (key[held] == key[left]) & (size[held] == size[left])
            alike = np.flatnonzero(hit)
            hit[alike] = _same_bytes(eight, at[left[alike]], at[held[alike]], size[left[alike]])
            self.slots[left[hit]] = probe[hit]
            left, probe = left[~hit], (probe[~hit] + 1) & (room - 1)
        self.count = np.bincount(self.slots, minlength=room)
        used = np.flatnonzero(owner >= 0)
        raw, crc32 = buffer.tobytes(), zlib.crc32
        begin = at[owner[used]]
        end = begin + size[owner[used]]
        crcs = [crc32(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
        self.bucket = np.zeros(room, np.int64)
        self.bucket[used] = np.array(crcs, np.int64) % buckets

    def per_bucket(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket, self.count, buckets).astype(np.int64)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lowered bytes of a column of texts (null: empty) and where each text begins."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return _LOWER[data], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, texts: int, size: int) -> Iterator[pa.RecordBatch]:
    """A batch cut between rows, into pieces whose texts have some ``size`` bytes each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(lengths) - lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for first, last in zip(edges[:-1], edges[1:]):
        yield batch.slice(first, last - first)


class Words:
    """The words of a column of texts: one buffer of them, a blank after each, their places and
    the row each is of."""

    def __init__(self, texts: pa.Array):
        data, offsets = _bytes_of(texts)
        inside = _IN_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(data) else inside
        after = np.concatenate((inside[1:], [False])) if len(data) else inside
        begin = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.size = end - begin
        self.at = np.cumsum(self.size + 1) - (self.size + 1)
        self.row = np.searchsorted(offsets, begin, "right") - 1
        self.buffer = np.full(len(begin) + self.size.sum(), 32, np.uint8)
        letters = np.ones(len(self.buffer), bool)
        letters[self.at + self.size] = False
        self.buffer[letters] = data[inside]
        self.per_row = np.bincount(self.row, minlength=len(texts))

    def features(self, params: Resampling) -> Iterator[tuple[FeatureTable, np.ndarray]]:
        """The features that begin at each ``chunk`` of the words: their table, and the row of
        each. Those that run past the chunk's end are whole, so a text of any length is taken in
        pieces of bounded size."""
        n = len(self.at)
        for first in range(0, n, params.chunk):
            last = min(first + params.chunk, n)
            reach = min(last + params.longest - 1, n)
            origin = self.at[first]
            buffer = self.buffer[origin : self.at[reach - 1] + self.size[reach - 1] + 1]
            at, size, row = [], [], []
            for longer in range(params.longest):
                begin = np.arange(first, min(last, n - longer))
                begin = begin[self.row[begin] == self.row[begin + longer]]
                at.append(self.at[begin] - origin)
                size.append(self.at[begin + longer] + self.size[begin + longer] - self.at[begin])
                row.append(self.row[begin])
            spans = np.concatenate(at), np.concatenate(size)
            yield FeatureTable(buffer, *spans, params.buckets), np.concatenate(row)


def bucket_counts(texts: DataFrame, params: Resampling = Resampling()) -> DataFrame:
    """(bucket, n): features of a one-column table of texts in each bucket, without those that
    hold none. A task sends one row for each bucket, at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, 0, params.piece):
                for found, _ in Words(piece.column(0)).features(params):
                    total += found.per_bucket(params.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = texts.mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, params: Resampling = Resampling()) -> list[int]:
    """For each bucket how much likelier the target has it than the documents, add-one smoothed:
    the scaled logarithm as a whole number. Both tables have one column of texts. The driver holds
    a number for each bucket."""
    counts = []
    for texts in (docs, target):
        found = np.zeros(params.buckets, np.int64)
        for bucket, n in bucket_counts(texts, params).collect():
            found[bucket] = n
        counts.append(found.tolist())
    s, t = counts
    s_all, t_all = (float(sum(c) + params.buckets) for c in counts)
    return [
        math.floor(params.scale * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all)))
        for b in range(params.buckets)
    ]


def weighed(docs: DataFrame, gains: list[int], params: Resampling = Resampling()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, text_key) of documents with columns doc_id and text.
    ``text_key``, a hash, tells rows of one id apart."""
    gain_of = np.array(gains, np.int64)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, 1, params.piece)):
            words = Words(batch.column(1))
            weight = np.zeros(batch.num_rows)
            n_features = np.zeros(batch.num_rows, np.int64)
            for found, row in words.features(params):
                gains_of_slots = gain_of[found.bucket]
                weight += np.bincount(row, gains_of_slots[found.slots], batch.num_rows)
                n_features += np.bincount(row, minlength=batch.num_rows)
            columns = (words.per_row, n_features, weight.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), batch.column(2)],
                ["doc_id", "n_words", "n_features", "weight", "text_key"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    schema = f"doc_id {kind}, n_words long, n_features long, weight long, text_key long"
    return rows.mapInArrow(weigh, schema)


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    params: Resampling = Resampling(),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, n_words, n_features, weight, text_key, score, and rank,
    which is null for what is not drawn.

    The score is the weight plus Gumbel noise fixed by seed and id, so the highest scores are a
    sample without replacement by weight. Two passes over the texts: one counts features in
    buckets, one weighs. Drawing orders all rows by range and numbers them, so no task holds more
    than its range and no threshold is estimated.

    Null and empty texts have no feature, weight 0, and are never drawn while ``min_words`` is
    above 0. A null id counts as an empty one. Rows that repeat an id are rows of their own; equal
    scores go to the smaller id, then to the smaller text_key; rows alike in all are drawn in any
    order, which the result cannot show. An empty table gives an empty result, an empty target
    leaves the documents' own counts to decide. Other columns are not read.
    """
    docs = one_text(docs, id_col, text_col)
    gains = bucket_gains(docs.select("text"), target.select(F.col(f"`{target_col}`").alias("text")), params)
    rows = written(weighed(docs, gains, params), "weighed")
    named = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-float(params.scale)) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))
    enough = F.col("n_words") >= params.min_words
    wanted = rows.where(enough).count() * params.percent // 100
    scored = rows.withColumn("score", F.col("weight") + noise).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc(), F.col("text_key").asc(), F.col("_row").asc()]
    placed = numbered(scored, order, "scored")
    rank = F.when(enough & (F.col("place") < wanted), F.col("place") + 1)
    return placed.withColumn("rank", rank).drop("_row", "place")


def draw(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn documents with all their columns, by the ranks of ``importance_ranks``."""
    chosen = ranks.where("rank IS NOT NULL").select(
        F.col("doc_id").alias("_drawn_id"), F.col("text_key").alias("_drawn_key")
    )
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn_id"))
    return docs.join(chosen, same & (F.xxhash64(f"`{text_col}`") == F.col("_drawn_key")), "left_semi")
