"""Language identification: nearest of several centroids per language by cosine."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

UNDETERMINED = "und"
BROADCAST_ROWS = 200_000
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Centroids:
    """Parameters of the vectors and of the fit."""

    slots: int = 4096
    orders: tuple[int, ...] = (1, 2, 3)
    clusters: int = 4
    rounds: int = 8
    share: float = 0.02  # of a language's texts, that a cluster has at least
    sample: int = 1_500  # documents clustered for each language, those least by hash of their id
    quantile: float = 0.001  # of the sample's own cosines, below which a text is rejected


@dataclass(frozen=True)
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray  # one row each, of length 1
    languages: list[str]  # of the rows of centroids
    reject: np.ndarray  # least cosine of the rows of centroids
    params: Centroids


@cache
def _letters() -> np.ndarray:
    """For each code point: itself if a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    points[~letter] = 32
    return points


def counts(text: str | None, params: Centroids) -> np.ndarray | None:
    """Counts of the hashed n-grams of letters and word ends of a whole text; None without a
    letter. A run of other characters is one word end."""
    if not text or not _LETTER.search(text):
        return None
    points = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    points = np.r_[np.uint32(32), points, np.uint32(32)]
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points = points[keep]
    total = np.zeros(params.slots, dtype=np.int64)
    step = 1 << 20
    for at in range(0, len(points), step):  # whole text, in bounded memory
        for order in params.orders:
            part = points[at : at + step + order - 1]
            n = len(part) - order + 1
            if n <= 0:
                continue
            h = np.full(n, order, dtype=np.uint32)
            for i in range(order):
                h = (h ^ part[i : i + n]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            total += np.bincount((h % np.uint32(params.slots)).astype(np.intp), minlength=params.slots)
    return total


def unit(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vector of length 1; term counts are damped by a square root."""
    vector = np.sqrt(found) * idf
    return vector / (np.linalg.norm(vector) or 1.0)


def cluster(vectors: np.ndarray, params: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids, and each one's least cosine. It starts from rows at even
    steps of the distance from the mean, not from the farthest rows, which may carry the wrong
    language. Clusters that hold less than ``share`` of the rows are given up, and the rest go
    on without them."""
    mean = vectors.sum(axis=0, dtype=np.float64)
    order = np.argsort(vectors @ mean, kind="stable")
    steps = (np.arange(params.clusters) + 0.5) / params.clusters * len(vectors)
    centroids = np.unique(vectors[order[steps.astype(int)]], axis=0).astype(np.float64)
    left = params.rounds
    while left:
        owner = np.argmax(vectors @ centroids.T, axis=1)
        for k in range(len(centroids)):
            mine = vectors[owner == k]
            if len(mine):
                mean = mine.sum(axis=0, dtype=np.float64)
                centroids[k] = mean / (np.linalg.norm(mean) or 1.0)
        left -= 1
        if not left:
            held = np.bincount(np.argmax(vectors @ centroids.T, axis=1), minlength=len(centroids))
            large = held >= params.share * len(vectors)
            if not large.all():
                centroids, left = centroids[large], params.rounds
    cosines = vectors @ centroids.T
    owner, best = np.argmax(cosines, axis=1), cosines.max(axis=1)
    floor = float(np.quantile(best, params.quantile))
    least = [
        min(floor, float(np.quantile(best[owner == k], params.quantile))) if (owner == k).any() else floor
        for k in range(len(centroids))
    ]
    return centroids, np.array(least)


def fit_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    params: Centroids = Centroids(),
) -> LanguageModel:
    """Document frequencies count over all of ``docs`` with a language and a letter; clusters
    are made from at most ``params.sample`` documents of each language. Rows without a
    language are not learnt from. No rows give a model without centroids, which calls every
    text undetermined."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").alias("lang"),
    ).where(F.col("lang").isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(params.slots, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found = counts(text, params)
                if found is not None:
                    seen += found > 0
                    n += 1
        yield pd.DataFrame({"slot": np.arange(-1, params.slots), "n": np.r_[n, seen]})

    # One row a slot and task, summed by Spark: as many rows come back as there are slots.
    df = rows.select("text").mapInPandas(frequencies, "slot int, n long")
    df = {r["slot"]: r["n"] for r in df.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    total = df.get(-1, 0)
    seen = np.array([df.get(i, 0) for i in range(params.slots)], dtype=np.float64)
    idf = np.log((1.0 + total) / (1.0 + seen)) + 1.0
    shared = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = counts(text, params)
                out.append(None if found is None else unit(found, shared.value).astype(np.float32).tobytes())
            yield batch[["lang", "rank"]].assign(vector=out).dropna(subset=["vector"])

    def fit(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["rank", "vector"])
        matrix = np.stack([np.frombuffer(v, np.float32) for v in batch["vector"]])
        centroids, least = cluster(matrix, params)
        return pd.DataFrame(
            {"lang": batch["lang"].iloc[0], "centroid": list(centroids), "least": least}
        )

    rows = rows.where(F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # A share of each language, so that the window below meets a bounded number of rows.
    share = F.least(F.lit(1.0), F.lit(4.0 * params.sample) / F.col("n"))
    place = F.pmod(F.xxhash64("id", "lang", F.lit(1)), F.lit(1 << 31))
    ranked = rows.select("id", "lang").distinct().join(sizes, "lang")
    ranked = ranked.where(place < share * (1 << 31))
    ranked = ranked.withColumn("rank", F.xxhash64("id", "lang")).withColumn(
        "place", F.expr("row_number() over (partition by lang order by rank, id)")
    )
    chosen = ranked.where(F.col("place") <= params.sample).select("id", "lang", "rank")
    chosen = written(chosen, "language-sample")
    if chosen.count() <= BROADCAST_ROWS:  # that is, unless there are very many languages
        chosen = F.broadcast(chosen)
    sample = rows.join(chosen, ["id", "lang"]).select("lang", "rank", "text")
    found = (
        sample.mapInPandas(vectors, "lang string, rank long, vector binary")
        .groupBy("lang")
        .applyInPandas(fit, "lang string, centroid array<double>, least double")
        .collect()
    )
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    return LanguageModel(
        idf,
        np.array([r["centroid"] for r in found]).reshape(len(found), params.slots),
        [r["lang"] for r in found],
        np.array([r["least"] for r in found]),
        params,
    )


def predict(text: str | None, model: LanguageModel) -> tuple[str, float, bool]:
    """Language of the nearest centroid, its cosine, and whether that is too far to trust."""
    found = counts(text, model.params)
    if found is None or not model.languages:
        return UNDETERMINED, 0.0, True
    cosines = model.centroids @ unit(found, model.idf)
    best = int(np.argmax(cosines))
    value = float(np.clip(cosines[best], 0.0, 1.0))
    return model.languages[best], value, bool(cosines[best] < model.reject[best])


def language_column(docs: DataFrame, text_col: str, model: LanguageModel):
    """Struct column: nearest (language of the nearest centroid, ``und`` for null texts and
    texts without a letter), score (its cosine), rejected (farther than all but a few of the
    texts that centroid was made from) and lang (``und`` if rejected)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("nearest string, score double, rejected boolean, lang string")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = [predict(t, shared.value) for t in batch]
            rows = [(*r, UNDETERMINED if r[2] else r[0]) for r in rows]
            yield pd.DataFrame(rows, columns=["nearest", "score", "rejected", "lang"]).astype(
                {"score": "float64", "rejected": "bool"}
            )

    return of(F.col(f"`{text_col}`"))
