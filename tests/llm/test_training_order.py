import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from shelfcast.llm.queries import LAYOUT
from shelfcast.llm.training_order import Layout, _encoder, count_ids, materialise, permute, read_slots, token_ids


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    index = np.arange(n)
    for key in (0, 1, 1 << 60):
        slots = permute(index, n, key)
        assert sorted(slots.tolist()) == list(range(n))
        assert permute(slots, n, key, inverse=True).tolist() == index.tolist()
    if n > 100:
        assert permute(index, n, 1).tolist() != permute(index, n, 2).tolist()
        assert abs(np.corrcoef(index, permute(index, n, 1))[0, 1]) < 0.2


@pytest.mark.parametrize(
    "text", ["a", " a", "a ", "a  b", "a \n b", "it's 3.5 o'clock!", "x y z", "é à\tb c", "a \x1c b", "don't 's", "\n"]
)
def test_token_ids(text):
    encoder = _encoder(LAYOUT)[0]
    assert isinstance(encoder, tiktoken.Encoding)
    assert token_ids(text, LAYOUT).tolist() == encoder.encode_ordinary(text)


def test_counts_agree_with_ids():
    rng = random.Random(1)
    parts = ["a", "the", " ", " ", " ", "  ", "\n", "é", "漢", "'s", "9", "\t", "\x1c", "\x85", "!?", "\u3000", "\xa0", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(3_000)]
    encoder = _encoder(LAYOUT)[0]
    want = [len(encoder.encode_ordinary(t)) for t in texts]
    column = pa.array(texts)
    assert [count_ids(column.slice(i, 1), LAYOUT) for i in range(len(texts))] == want
    assert count_ids(column, LAYOUT) == sum(want)
    assert count_ids(column.slice(7, 900), LAYOUT) == sum(want[7:907])
    assert count_ids(column.slice(0, 0), LAYOUT) == 0


def layout(**changes):
    return Layout(**(LAYOUT.__dict__ | {"length": 8, "shard_slots": 4} | changes))


def test_shards(docs_of):
    texts = [f"document {i} " + "with some more words " * (i % 7) for i in range(60)] + [None, "", "long " * 5_000]
    docs = docs_of(texts, slot="1", part="2", shard="3").repartitionByRange(3, "doc_id")
    small = layout()
    root, manifest = materialise(docs, small)
    rows = manifest.orderBy("slot").collect()
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n))
    folder = root.removeprefix("file://")
    files = sorted(f for f in os.listdir(folder) if not f.startswith("."))
    assert files == [f"shard-{i:08d}.bin" for i in range(-(-n // 4))]
    sizes = [os.path.getsize(f"{folder}/{f}") for f in files]
    assert sum(sizes) == n * small.stride and set(sizes[:-1]) <= {4 * small.stride}
    ids = list(read_slots(root, small, 0, n))
    by_seq = {}
    for row, found in zip(rows, ids, strict=True):
        assert row.shard == row.slot // 4 and row.byte_offset == row.slot % 4 * small.stride
        assert hashlib.sha256(found.tobytes()).hexdigest() == row.ids_sha256
        assert set(found[row.n_ids :].tolist()) <= {small.end_id}
        assert int(permute(np.array([row.seq]), n, small.key)[0]) == row.slot
        by_seq[row.seq] = (row, found)
    # In order of their numbers the sequences hold every text once, each with its end.
    streams, texts_found = {}, {}
    wanted = {i: token_ids(t, small).tolist() for i, t in enumerate(texts) if t}
    flat = [x for seq in sorted(by_seq) for x in by_seq[seq][1][: by_seq[seq][0].n_ids].tolist()]
    assert len(flat) == sum(len(w) + 1 for w in wanted.values())
    cut, pieces = [], []
    for x in flat:
        if x == small.end_id:
            pieces.append(cut)
            cut = []
        else:
            cut.append(x)
    assert sorted(map(tuple, pieces)) == sorted(tuple(w) for w in wanted.values())
    for row, found in by_seq.values():
        own = [*wanted[row.first_doc], small.end_id][row.first_at :]
        k = min(len(own), row.n_ids)
        assert found[:k].tolist() == own[:k]
        assert row.n_docs == 1 + found[: row.n_ids - 1].tolist().count(small.end_id)
    resumed = list(read_slots(root, small, 5, 6))
    assert [a.tolist() for a in resumed] == [a.tolist() for a in ids[5:11]]


def test_running_again_gives_the_same(docs_of):
    docs = docs_of([f"text number {i}" for i in range(30)])
    one, two = (materialise(docs, layout())[1].orderBy("slot").collect() for _ in range(2))
    assert one == two
    other = materialise(docs, layout(key=9))[1].orderBy("slot").collect()
    assert [r.seq for r in other] != [r.seq for r in one]


def test_edges(docs_of):
    _, manifest = materialise(docs_of([("x", "y")][:0]), layout())
    assert manifest.collect() == []
    _, manifest = materialise(docs_of([(None, "a b"), (1, None), (1, "")]), layout())
    (row,) = manifest.collect()
    assert row.first_doc is None and row.n_ids == 3 and row.n_docs == 1


def test_several_shards_a_task_and_wide_ids(docs_of):
    docs = docs_of([f"document {i} " + "with some more words " * (i % 7) for i in range(60)])
    plain = layout()
    root, manifest = materialise(docs, plain)
    rows = manifest.orderBy("slot").collect()
    want = [x.tolist() for x in read_slots(root, plain, 0, len(rows))]
    for changes in ({"write_tasks": 2}, {"write_tasks": 1, "id_bytes": 4}):
        other = layout(**changes)
        where, found = materialise(docs, other)
        again = found.orderBy("slot").collect()
        assert [(r.slot, r.seq, r.shard, r.n_ids) for r in again] == [(r.slot, r.seq, r.shard, r.n_ids) for r in rows]
        assert [x.tolist() for x in read_slots(where, other, 0, len(rows))] == want
        assert len(list(found.inputFiles())) <= other.write_tasks
    with pytest.raises(ValueError, match="id_bytes"):
        token_ids("a", layout(end_id=70_000))
    assert token_ids("a b", layout(end_id=70_000, id_bytes=4)).dtype == np.uint32
