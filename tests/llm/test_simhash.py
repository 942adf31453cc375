import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import simhash
from shelfcast.llm.components import connected_components
from shelfcast.llm.simhash import block_keys, fingerprint, linked_fingerprints, simhash_components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "a b c", "a b c d", "É ß 漢字 a b", "x " * 5000, "A\x0bB\x0cC D E F"])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_long_text_in_parts():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert fingerprint(text) == slow_fingerprint(text)


def random_prints(n=400, seed=2):
    rng = random.Random(seed)
    prints = {0, (1 << 64) - 1}
    for _ in range(n // 4):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(3):
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                base ^= 1 << bit
            prints.add(base)
    return sorted(prints)


@pytest.mark.parametrize("distance, blocks", [(4, 5), (4, 6), (4, 8), (1, 4), (2, 4)])
def test_links_connect_all_within_the_distance(spark, distance, blocks):
    prints = random_prints()
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance]
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in linked_fingerprints(frame, distance, blocks).collect()]
    assert components(got, prints) == components(near, prints)


def test_large_blocks_are_cut_and_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 16)
    rng = random.Random(4)
    prints = sorted({sum(1 << b for b in rng.sample(range(20), 3)) for _ in range(300)})
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.a, r.b) for r in linked_fingerprints(frame, 2, 4).collect()]
    assert components(links, prints) == components(near, prints)
    ball = spark.createDataFrame([(signed(p),) for p in [0, *(1 << b for b in range(64))]], "fp long")
    assert linked_fingerprints(ball, 2, 4).count() < 65 * 64 / 2  # a dense group gives few links


def test_keys_are_as_many_as_choices(spark):
    assert spark.range(1).select(F.size(block_keys(F.col("id"), 4, 6)).alias("n")).first().n == 15
    with pytest.raises(ValueError):
        block_keys(F.col("id"), 4, 4)


def test_documents(docs_of):
    rng = random.Random(6)
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 5) for _ in range(60)) for _ in range(12)]
    texts = []
    for text in base:
        words = text.split()
        texts += [text, text.upper(), " ".join(["new", *words[1:]]), " ".join(words[:-1])]
    texts += ["", None, " ", "one two", "one two"]
    rng.shuffle(texts)
    prints = [slow_fingerprint(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = components(links, range(len(texts)))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash_components(docs_of(texts)).collect()}
    assert got == {i: (prints[i], want[i]) for i in range(len(texts))}
    assert len(set(want.values())) < len(texts)


def test_edges(docs_of):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (1, "other words here too"), (2, None)]
    got = sorted(map(tuple, simhash_components(docs_of(rows, fp="7", key="8", least="9")).collect()), key=str)
    p, q = signed(slow_fingerprint("a b c")), signed(slow_fingerprint("other words here too"))
    assert got == sorted([(None, p, None), (3, p, 3), (3, p, 3), (1, q, 1), (2, 0, 2)], key=str)
    assert simhash_components(docs_of([("x", "y")][:0])).collect() == []


def test_components_of_chains_hubs_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, 1001 + i) for i in range(50)]
    edges = [*chain, *hub, (7, 7), (None, 3), (5, 4), (4, 5)]
    rows = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(rows).collect()}
    want = {i + 1: 100 for i, _ in chain} | {b: 1000 for _, b in hub} | {5: 4}
    assert {i: got[i] for i in want} == want and len(got) == len(want)
    assert connected_components(rows.limit(0)).collect() == []
    ids = np.random.default_rng(1).integers(0, 300, (250, 2)).tolist()
    want = components([tuple(e) for e in ids], {n for e in ids for n in e})
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(ids, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n != c}
