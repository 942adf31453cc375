import random

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm.quality import Ftrl, features, fit_quality, ngram_slots, score, score_column, token_hashes, train

PARAMS = Ftrl(bits=14, epochs=2)


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(5, 60))]
        if i % 4 == 0:
            words = [w + rng.choice(["!!", "$$$"]) for w in words]
        elif i % 4 == 1:
            words = [w for w in words[:6] for _ in range(9)]
        out.append((" ".join(words), int(i % 4 > 1)))
    return out


def slow_train(rows, p):
    """The learner one weight at a time."""
    z, n = {}, {}

    def weight(s):
        if abs(z.get(s, 0.0)) <= p.l1:
            return 0.0
        return -(z[s] - np.sign(z[s]) * p.l1) / ((p.beta + np.sqrt(n[s])) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for text, label in rows:
            slots, values = features(text, p.bits)
            w = [weight(s) for s in slots]
            prob = 1 / (1 + np.exp(-np.dot(w, values)))
            for s, v, now in zip(slots.tolist(), values, w, strict=True):
                g = (prob - label) * v
                old = n.get(s, 0.0)
                n[s] = old + g * g
                z[s] = z.get(s, 0.0) + g - (np.sqrt(n[s]) - np.sqrt(old)) / p.alpha * now
    return {s: weight(s) for s in z}


def test_updates_agree_with_one_weight_at_a_time():
    rows = [(t, y) for t, y in texts(40)] + [("", 1), (None, 0)]
    fast, slow = train(rows, PARAMS), slow_train(rows, PARAMS)
    assert np.count_nonzero(fast) == sum(w != 0 for w in slow.values())
    assert all(abs(fast[s] - w) < 1e-9 for s, w in slow.items())


def test_score_is_the_sparse_product():
    weights = np.random.default_rng(1).standard_normal(1 << 14)
    for text in ["a b a b", "One", "", None, "x " * 9, "a\n\nb ### C"]:
        slots, values = features(text, 14)
        assert len(set(slots.tolist())) == len(slots)
        assert abs(score(text, weights, 14) - 1 / (1 + np.exp(-weights[slots] @ values))) < 1e-9


def test_tokens():
    assert len(token_hashes("Aa, bb.\n$$$")) == 5
    assert token_hashes("AB")[0] != token_hashes("ab")[0] == token_hashes("Ab")[0]
    assert ngram_slots(" \n", 14) == []


def test_held_out_accuracy(spark, docs_of):
    rows = texts(600)
    docs = docs_of([(i, t) for i, (t, _) in enumerate(rows)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int")
    weights = fit_quality(docs, labels, usable=F.col("id") % 3 != 0, params=PARAMS)
    scored = docs.select("doc_id", score_column(docs, F.col("text"), weights, PARAMS.bits).alias("p")).collect()
    held = [(r.p >= 0.5) == bool(rows[r.doc_id][1]) for r in scored if r.doc_id % 3 == 0]
    assert sum(held) / len(held) > 0.95
    assert np.array_equal(weights, fit_quality(docs, labels, usable=F.col("id") % 3 != 0, params=PARAMS))


def test_edges(spark, docs_of):
    schema = "doc_id long, quality int"
    none = spark.createDataFrame([], schema)
    docs = docs_of([(None, "a"), (1, None), (1, ""), (2, "b " * 50_000)], label="1", rank="2", score="3")
    weights = fit_quality(docs, none, params=PARAMS)
    assert not weights.any()
    assert [r.p for r in docs.select(score_column(docs, F.col("text"), weights, PARAMS.bits).alias("p")).collect()] == [0.5] * 4
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 7), (2, 1), (2, 0), (2, 0), (9, 1)], schema)
    assert fit_quality(docs, odd, params=PARAMS)[0] < 0  # one row, of the lesser of its labels
    empty = docs_of([("x", "y")][:0])
    assert empty.select(score_column(empty, F.col("text"), weights, PARAMS.bits)).collect() == []
