import random

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm.language import UNDETERMINED, Centroids, cluster, counts, fit_languages, language_column, predict, unit

PARAMS = Centroids(slots=1024, clusters=3, sample=100)
SYLLABLES = {"aa": ["ka", "lo", "mi", "té"], "bb": ["sch", "ung", "ei", "ßt"], "cc": ["ция", "но", "ст", "же"]}


def text(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark, n=90):
    rows = [(i, text(lang, 3 + i % 40, i), lang) for i, lang in zip(range(n), [*SYLLABLES] * n, strict=False)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def slow_counts(value, params):
    points = [ord(c) if c.isalpha() else 32 for c in f" {value.lower()} "]
    points = [p for i, p in enumerate(points) if p != 32 or not i or points[i - 1] != 32]
    out = np.zeros(params.slots, dtype=int)
    for order in params.orders:
        for i in range(len(points) - order + 1):
            h = order
            for p in points[i : i + order]:
                h = (h ^ p) * 0x9E3779B1 % (1 << 32)
                h ^= h >> 15
            out[h % params.slots] += 1
    return out


def test_counts():
    for value in ["a", "Ab, c!", "12 é 34", " x ", "漢字 kana", "\U0001d400 b"]:
        assert counts(value, PARAMS).tolist() == slow_counts(value, PARAMS).tolist()
    assert counts(None, PARAMS) is counts("", PARAMS) is counts("12 !?_", PARAMS) is None
    assert counts("ab " * 600_000, PARAMS).sum() == 3 * 600_000 * 3


def test_document_frequencies_cover_all_rows(spark):
    rows, docs = corpus(spark)
    model = fit_languages(docs.repartition(5), params=PARAMS)
    seen = sum((counts(t, PARAMS) > 0).astype(int) for _, t, _ in rows)
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + seen)) + 1)
    assert sorted(set(model.languages)) == sorted(SYLLABLES)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1)


def test_held_out_accuracy_and_brute_force(spark):
    rows, docs = corpus(spark)
    model = fit_languages(docs.where("doc_id % 4 != 2"), params=PARAMS)
    found = docs.select("doc_id", language_column(docs, "text", model).alias("f")).select("doc_id", "f.*").collect()
    for row in found:
        vector = unit(counts(rows[row.doc_id][1], PARAMS), model.idf)
        cosines = [float(c @ vector) for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert row.nearest == model.languages[best] and abs(row.score - cosines[best]) < 1e-9
        assert row.rejected == (cosines[best] < model.reject[best])
        assert row.lang == (UNDETERMINED if row.rejected else row.nearest)
    held = [r.nearest == rows[r.doc_id][2] for r in found if r.doc_id % 4 == 2]
    assert all(held)


def test_far_texts_are_rejected(spark):
    _, docs = corpus(spark)
    model = fit_languages(docs, params=PARAMS)
    assert predict("ωψχ φυτσ ρπο ξνμλκ", model)[2]
    assert not predict(text("aa", 30, "new"), model)[2]


def test_clusters():
    rng = np.random.default_rng(1)
    centres = np.eye(6)[:3]
    rows = np.repeat(centres, 20, axis=0) + 0.05 * rng.standard_normal((60, 6))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found, least = cluster(rows, Centroids(clusters=3))
    assert sorted(np.argmax(found, axis=1).tolist()) == [0, 1, 2] and (least > 0.9).all()
    same, _ = cluster(rows[:1].repeat(5, axis=0), Centroids(clusters=3))
    assert len(same) == 1


def test_edges(spark):
    schema = "doc_id long, text string, lang string, rank int, place int, lang_pred int"
    rows = [(None, "ka lo", "aa", 1, 2, 3), (1, None, "aa", 1, 2, 3), (2, "123", "bb", 1, 2, 3), (3, "ka", None, 1, 2, 3)]
    docs = spark.createDataFrame([*rows, rows[2]], schema)
    for part in (docs, docs.limit(0)):
        model = fit_languages(part, params=PARAMS)
        found = docs.select(language_column(docs, "text", model).alias("f")).select("f.*").collect()
        assert [r.nearest for r in found[1:3]] == [UNDETERMINED] * 2 and found[1].score == 0.0
    assert docs.limit(0).select(language_column(docs, "text", model)).collect() == []
    assert docs.where(F.col("doc_id") == 3).select(language_column(docs, "text", model)["nearest"]).first()[0] == UNDETERMINED
