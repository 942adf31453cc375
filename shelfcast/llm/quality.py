"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hashed_share

TOKEN = re.compile(r"\w+|[^\w\s]+")
SCALE = 10.0  # shares are small; this brings them near the intercept's 1
_CACHE_MOST = 200_000
_cache: dict[str, int] = {}


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the features and of the learner."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3
    sample: int = 12_000  # labelled rows learnt from, at most; those least by hash of their id


def _token_hash(token: str) -> int:
    """32-bit hash. Capitals count: the shape of a word goes before its folded letters."""
    shape = "A" if token.isupper() and len(token) > 1 else "a"
    return zlib.crc32(f"{shape}{token.lower()}".encode("utf-8", "replace"))


def token_hashes(text: str | None) -> np.ndarray:
    """Hash of each token (run of word characters or of other signs), in order."""
    tokens = TOKEN.findall(text or "")
    if len(_cache) > _CACHE_MOST:
        _cache.clear()
    for token in {t for t in tokens if t not in _cache}:
        _cache[token] = _token_hash(token)
    return np.fromiter(map(_cache.__getitem__, tokens), np.uint64, len(tokens))


def ngram_slots(text: str | None, bits: int) -> list[np.ndarray]:
    """Slots of the hashed n-grams of a whole text, repeats included, by kind: unigrams,
    bigrams, and whether a bigram is a token twice. Slots 0 to 2 are kept for the intercept
    and that last kind."""
    h = token_hashes(text)
    room = np.uint64((1 << bits) - 3)
    if not len(h):
        return []
    groups = [(h % room + np.uint64(3)).astype(np.int64)]
    if len(h) > 1:
        a, b = h[:-1], h[1:]
        mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        groups.append((mixed % room + np.uint64(3)).astype(np.int64))
        groups.append(np.where(a == b, 1, 2))
    return groups


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vector of a whole text: slots (sorted, each once) and values. Values are shares
    of their kind, so the length of a text has no part. Slot 0 is the intercept."""
    groups = ngram_slots(text, bits)
    slots = np.concatenate([np.array([0]), *groups])
    values = np.concatenate([np.array([1.0]), *[np.full(len(g), SCALE / len(g)) for g in groups]])
    found, place = np.unique(slots, return_inverse=True)
    return found, np.bincount(place, values)


def train(rows: list[tuple[str | None, int]], params: Ftrl) -> np.ndarray:
    """Weights by follow-the-regularised-leader, rows in the order given."""
    size = 1 << params.bits
    z, n = np.zeros(size), np.zeros(size)
    vectors = [(*features(text, params.bits), float(label)) for text, label in rows]

    def weights(slots):
        zs, ns = z[slots], n[slots]
        w = -(zs - np.sign(zs) * params.l1) / ((params.beta + np.sqrt(ns)) / params.alpha + params.l2)
        return np.where(np.abs(zs) <= params.l1, 0.0, w)

    for _ in range(params.epochs):
        for slots, values, label in vectors:
            w = weights(slots)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            grown = n[slots] + g * g
            z[slots] += g - (np.sqrt(grown) - np.sqrt(n[slots])) / params.alpha * w
            n[slots] = grown
    return weights(np.arange(size))


def score(text: str | None, weights: np.ndarray, bits: int) -> float:
    """Sparse dot product of a whole text's vector with the weights, as a probability."""
    total = weights[0]
    for slots in ngram_slots(text, bits):
        total += SCALE * weights[slots].mean()
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_id: str,
    label_col: str,
    usable: Column | None,
    most: int,
) -> DataFrame:
    """(rank, text, label) of at most ``most`` labelled documents, those with the least hash of
    their id; ``usable`` is a condition on ``id``. Several labels of an id count as their
    least, several texts as their least; rows with a null id or label are not used."""
    rows = labels.select(
        F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.where(hashed_share(F.col("id"), most, rows.count()))
    rows = rows.groupBy("id").agg(F.min("label").alias("label"))
    rows = rows.withColumn("rank", F.xxhash64("id")).orderBy("rank", "id").limit(most)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # ``rows`` has at most ``most`` rows, whatever the size of the tables.
    joined = texts.join(F.broadcast(rows), "id")
    return joined.groupBy("rank", "id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    usable: Column | None = None,
    params: Ftrl = Ftrl(),
) -> np.ndarray:
    """Weights, learnt in one task from at most ``params.sample`` rows. Only weights that are
    not 0 come to the driver. Without labelled rows all weights are 0 and all scores 0.5."""
    sample = labelled_sample(
        docs, labels, id_col, text_col, label_id, label_col, usable, params.sample
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(t, y) for b in batches for t, y in zip(b["text"], b["label"], strict=True)]
        weights = train(rows, params)
        slots = np.flatnonzero(weights)
        yield pd.DataFrame({"slot": slots, "weight": weights[slots]})

    one = sample.repartition(1).sortWithinPartitions("rank", "id").select("text", "label")
    weights = np.zeros(1 << params.bits)
    for row in one.mapInPandas(learn, "slot long, weight double").collect():
        weights[row["slot"]] = row["weight"]
    return weights


def score_column(docs: DataFrame, text: Column, weights: np.ndarray, bits: int) -> Column:
    """Probability of label 1 for whole texts; null and empty texts get the intercept's."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([score(t, shared.value, bits) for t in batch], dtype="float64")
        _cache.clear()  # the worker may serve another stage next

    return of(text)
