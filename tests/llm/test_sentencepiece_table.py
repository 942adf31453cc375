import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from shelfcast.llm import sentencepiece_table
from shelfcast.llm.queries import PIECES
from shelfcast.llm.sentencepiece_table import (
    chunkable,
    chunks,
    encode_documents,
    segment,
    unvarint,
    varint,
)

SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
PARTS = ["a", "b", " ", "  ", "▁", "\n", "é", "the", "　", "\U0001f600", ".", " the", "\t", "\x00", "<s>", "</s>", "<0x41>", "ﬁ", "́"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_chunks_segment_and_decode_as_the_library_does():
    assert chunkable(PIECES)
    for text in random_texts(5_000):
        table = segment(chunks(text), PIECES) if text else []
        assert [i for ids in table for i in ids] == SP.encode(text)
        assert " ".join(SP.decode(table) if table else []) == SP.decode(SP.encode(text))


def test_varint():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 1 << 21, (1 << 28) - 1, 1 << 28, (1 << 35) - 1])
    assert unvarint(varint(values)).tolist() == values.tolist()
    assert len(varint(values[:3])) == 3 and unvarint(b"").tolist() == [] == unvarint(varint([])).tolist()


@pytest.mark.parametrize("block_chars", [1, 50, 16_000_000])
def test_round_trip(docs_of, block_chars):
    texts = [*random_texts(150, 2), None, "", "▁", " ", "word " * 20_000, "x" * 3_000, "same", "same"]
    docs = docs_of(texts, ids="1", block="2", places="3")
    got = encode_documents(docs, PIECES, ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"), block_chars=block_chars, parts=5)
    rows = got.collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = SP.encode(texts[row.doc_id] or "")
        text = SP.decode(ids)
        assert row.ids == ids and row.n_tokens == len(ids) and row.decoded == text
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_parts_grow_with_the_corpus(spark, docs_of):
    docs = docs_of(random_texts(300, 3))
    size = sum(len(t.encode()) for t in random_texts(300, 3))
    few, many = (encode_documents(docs, PIECES, ("n_tokens", "ids_sha256"), part_bytes=b) for b in (1 << 28, size // 40))
    assert few.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert many.rdd.getNumPartitions() in (40, 41)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_ids_beyond_two_bytes(docs_of, monkeypatch):
    assert sentencepiece_table.id_type(PIECES) is np.uint16
    texts = random_texts(100, 4)
    monkeypatch.setattr(sentencepiece_table, "id_type", lambda model: np.uint32)
    got = encode_documents(docs_of(texts), PIECES, ("ids", "decoded")).collect()
    assert all(r.ids == SP.encode(texts[r.doc_id]) and r.decoded == SP.decode(r.ids) for r in got)


def test_edges(docs_of):
    rows = [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]
    got = encode_documents(docs_of(rows), PIECES, ("n_tokens",)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2), (1, 2), (1, 2), (2, 0)], key=str)
    assert encode_documents(docs_of([("x", "y")][:0]), PIECES).collect() == []
    assert [r.n_tokens for r in encode_documents(docs_of(["", None]), PIECES, ("n_tokens",)).collect()] == [0, 0]
