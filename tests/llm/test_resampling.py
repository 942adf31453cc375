"""Importance resampling against a loop over words, and its parts against libraries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from shelfcast.llm import resampling
from shelfcast.llm.resampling import FeatureTable, Resampling, Words, bucket_counts, draw, importance_ranks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = Resampling(chunk=7)


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def features_of(text):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    s, t = (Counter(bucket(f) for x in texts for f in features_of(x)) for texts in ([r[1] for r in rows], target))
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    found = []
    for doc_id, text in rows:
        gains = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in map(bucket, features_of(text))]
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = sum(gains) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(words_of(text)), len(gains), sum(gains), score, None])
    enough = sorted((r for r in found if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, found), key=str)


def ranks(spark, rows, target, params=SMALL):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS score", "'x' AS rank")
    items = spark.createDataFrame([(x, 1) for x in target], "text string, weight int")
    got = importance_ranks(docs, items, params)
    return sorted(map(tuple, got.drop("text_key").collect()), key=str), docs, got


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocabulary = ["ab", "Cd", "naïve", "x" * 40, "日本", "e9", "wörter", "so", "q" * 31, "r" * 33]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "\n", " --"]) for _ in range(rng.randrange(60))) for _ in range(n)]
    return list(enumerate(texts))


def test_matches_a_loop(spark):
    rows = corpus(150)
    rows += [(200, None), (201, ""), (202, " ,;\x00"), (203, rows[3][1]), (203, rows[3][1]), (None, rows[5][1])]
    rows.append((204, "word " * 30_000))
    target = [rows[9][1], rows[10][1], None, ""]
    got, docs, ranked = ranks(spark, rows, target)
    assert got == brute(rows, target)
    drawn = draw(docs, ranked)
    assert drawn.columns == docs.columns
    assert sorted(r[0] for r in drawn.collect()) == sorted(r[0] for r in got if r[5] is not None)


def test_ties_go_to_the_smaller_id_and_repeated_rows_stay(spark, monkeypatch):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    rows = [(7, text)] * 30 + [(8, text)] * 10
    got, _, ranked = ranks(spark, rows, [])
    assert len(got) == 40 and got == brute(rows, [])
    assert ranked.where("rank IS NOT NULL").count() == 2


def test_empty_tables(spark):
    assert ranks(spark, [], ["a b"])[0] == []
    rows = [(1, "a b c"), (2, None)]
    assert ranks(spark, rows, [])[0] == brute(rows, [])


def test_hash_agrees_with_the_library():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) for _ in range(3000))
    spans = [(rng.randrange(2500), rng.randrange(200)) for _ in range(500)] + [(0, n) for n in range(70)]
    at, size = (np.array(x) for x in zip(*spans))
    got = resampling.xxhash64_spans(resampling.eights(np.frombuffer(raw, np.uint8)), at, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(raw[a : a + n]) for a, n in spans]


def test_table_tells_spans_of_one_key_apart(monkeypatch):
    """With a hash that is the same for all, bytes alone decide."""
    monkeypatch.setattr(resampling, "xxhash64_spans", lambda eight, at, size: np.zeros(len(at), np.uint64))
    raw = np.frombuffer(b"one two one three two one twofold twofolk", np.uint8)
    at = np.array([0, 4, 8, 12, 18, 22, 26, 34])
    size = np.array([3, 3, 3, 5, 3, 3, 7, 7])
    table = FeatureTable(raw, at, size, 10_000)
    spans = [bytes(raw[a : a + n]) for a, n in zip(at, size)]
    assert len(set(table.slots)) == len(set(spans)) == 5
    for span, slot in zip(spans, table.slots):
        assert table.count[slot] == spans.count(span) and table.bucket[slot] == bucket(span.decode())


def test_words_do_not_cross_rows():
    words = Words(pa.array(["ab", "cd", None, "", "e f", "g"]))
    assert words.per_row.tolist() == [1, 1, 0, 0, 2, 1]
    assert bytes(words.buffer) == b"ab cd e f g "
    sliced = Words(pa.array(["zz", "ab", "c d", "yy"]).slice(1, 2))
    assert bytes(sliced.buffer) == b"ab c d " and sliced.per_row.tolist() == [1, 2]


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_chunks_change_nothing(spark, chunk):
    texts = spark.createDataFrame([(t,) for _, t in corpus(20)], "text string")
    got = {r[0]: r[1] for r in bucket_counts(texts, Resampling(chunk=chunk)).collect()}
    assert got == Counter(bucket(f) for _, t in corpus(20) for f in features_of(t))


def test_draws_what_is_like_the_target(spark):
    rng = random.Random(5)
    plain, wanted = ([f"{p}{i}" for i in range(50)] for p in "pw")
    rows = [(i, " ".join(rng.choices(wanted if i % 10 == 0 else plain, k=40))) for i in range(400)]
    target = [" ".join(rng.choices(wanted, k=200)) for _ in range(5)]
    got, _, _ = ranks(spark, rows, target, Resampling())
    drawn = [r[0] for r in got if r[5] is not None]
    assert len(drawn) == 20 and all(d % 10 == 0 for d in drawn)
