"""Training-order materialisation: token sequences, Feistel slots, fixed-stride shards."""

from __future__ import annotations

import base64
import hashlib
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import one_text, shared_path

# The characters that count as white space.
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = f"^ | $| {_WHITE}|{_WHITE} "
_COUNT_BYTES = 16_000_000
_encoders: dict[tuple, tuple[tiktoken.Encoding, np.ndarray]] = {}


@dataclass(frozen=True)
class Layout:
    """Parameters of the sequences and shards."""

    ranks: str  # file of token ranks
    pattern: str  # that cuts a text into words before merging
    end_id: int  # after each text, and as filling at the end of a partition
    length: int = 1024  # ids in a sequence
    shard_slots: int = 4096
    key: int = 0x5EED
    rounds: int = 6
    id_bytes: int = 2  # of an id, a little-endian unsigned number; 2 or 4
    write_tasks: int = 20_000  # at most; beyond it a task writes several shards, one by one

    @property
    def ids(self) -> np.dtype:
        return np.dtype(f"<u{self.id_bytes}")

    @property
    def stride(self) -> int:
        return self.id_bytes * self.length  # bytes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int, rounds: int) -> np.ndarray:
    seeds = np.array([(key + (r + 1) * 0x9E3779B97F4A7C15) % (1 << 64) for r in range(rounds)], np.uint64)
    return _mix(seeds)


def permute(index: np.ndarray, n: int, key: int, rounds: int = 6, inverse: bool = False) -> np.ndarray:
    """Keyed permutation of 0 .. n - 1: a balanced Feistel network over the least even number
    of bits that holds n, applied again to what falls outside (cycle-walking)."""
    index = np.asarray(index, dtype=np.uint64)
    if n <= 1:
        return index.copy()
    half = np.uint64(((n - 1).bit_length() + 1) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(key, rounds)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << half) | right

    out = once(index)
    while len(outside := np.flatnonzero(out >= np.uint64(n))):
        out[outside] = once(out[outside])
    return out


def _encoder(layout: Layout):
    known = (layout.ranks, layout.pattern, layout.id_bytes, layout.end_id)
    if known not in _encoders:
        with open(layout.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        most = max(*ranks.values(), layout.end_id)
        if most >= 1 << 8 * layout.id_bytes:
            raise ValueError(f"ids up to {most} do not fit {layout.id_bytes} bytes: set id_bytes=4")
        made = tiktoken.Encoding(
            "ids", pat_str=layout.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        begins = np.zeros(most + 1, dtype=bool)  # whether an id begins with a blank
        begins[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
        _encoders[known] = (made, begins)
    return _encoders[known]


def token_ids(text: str, layout: Layout) -> np.ndarray:
    encoder, _ = _encoder(layout)
    kind = "H" if layout.id_bytes == 2 else "I"
    return np.frombuffer(array(kind, encoder.encode_ordinary(text)), layout.ids)


def count_ids(texts: pa.Array, layout: Layout) -> int:
    """Number of ids of all texts, none of which is empty or null. A blank that stands by itself
    between two characters that are none always begins a token. Texts all of whose blanks do
    so are cut there, and each distinct word is encoded once."""
    encoder, begins = _encoder(layout)
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    total = sum(len(encoder.encode_ordinary(t.as_py())) for t in texts.filter(uneven))
    lists = pc.split_pattern(texts.filter(pc.invert(uneven)), " ")
    if not len(lists):
        return total
    words = lists.flatten()
    first = np.zeros(len(words), dtype=bool)
    first[np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()] = True
    total += sum(len(encoder.encode_ordinary(w.as_py())) for w in words.filter(pa.array(first)))
    found = pc.value_counts(words.filter(pa.array(~first)))
    if len(found):
        listed = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found.field("values"))
        ids = encoder.encode_ordinary(f" {pc.binary_join(listed, ' ')[0].as_py()}")
        lengths = np.diff(np.flatnonzero(begins[ids]), append=len(ids))
        total += int(lengths @ np.asarray(found.field("counts")))
    return total


def _counter(layout: Layout):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            texts = batch.column(0)
            total += len(texts)  # each text has an end
            part = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64) // _COUNT_BYTES
            cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)].tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                total += count_ids(texts.slice(a, b - a), layout) if b > a else 0
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "n": pa.array([-(-total // layout.length)])}
        )

    return count


def _sequences(layout: Layout, offsets: dict[int, int], counts: dict[int, int], n: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        made, size = 0, layout.length
        rest = np.empty(0, layout.ids)  # ids that wait for a full sequence
        docs: list[tuple[int | None, int, int]] = []  # id, place of its first id in rest, skipped

        def cut(final: bool) -> pd.DataFrame:
            nonlocal made, rest, docs
            full = len(rest) // size
            used = [size] * full
            if final and len(rest) % size:
                used.append(len(rest) % size)
                fill = np.full(size - used[-1], layout.end_id, layout.ids)
                rest = np.concatenate([rest, fill])
                full += 1
            starts = np.arange(full) * size
            at = np.array([d[1] for d in docs], dtype=np.int64)
            first = np.searchsorted(at, starts, side="right") - 1
            last = np.searchsorted(at, starts + np.array(used, dtype=np.int64), side="left") - 1
            index = np.arange(made, made + full, dtype=np.uint64) + np.uint64(offsets[part])
            rows = pd.DataFrame(
                {
                    "slot": permute(index, n, layout.key, layout.rounds).astype(np.int64),
                    "seq": index.astype(np.int64),
                    "first_doc": pd.array([docs[i][0] for i in first], dtype="Int64"),
                    "first_at": [int(s - at[i] + docs[i][2]) for s, i in zip(starts, first, strict=True)],
                    "n_docs": last - first + 1,
                    "n_ids": used,
                    "ids": [rest[s : s + size].tobytes() for s in starts],
                }
            )
            made += full
            if full:
                end = full * size
                rest = rest[end:]
                going = [d for d in docs if d[1] >= end]
                before = [d for d in docs if d[1] < end]
                if len(rest) and before and not (going and going[0][1] == end):
                    ident, start, skipped = before[-1]
                    going.insert(0, (ident, end, skipped + end - start))
                docs = [(i, start - end, skipped) for i, start, skipped in going]
            return rows

        for batch in batches:
            new, length = [rest], len(rest)
            for ident, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = token_ids(text, layout)
                docs.append((None if pd.isna(ident) else int(ident), length, 0))
                new += [ids, np.array([layout.end_id], layout.ids)]
                length += len(ids) + 1
            rest = np.concatenate(new)
            yield cut(False)
        yield cut(True)
        if made != counts[part]:
            raise RuntimeError("the documents changed between counting and writing")

    return build


def _writer(layout: Layout, root: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = pafs.FileSystem.from_uri(root)
        shard, sink, name, sent = None, None, "", 0

        def close() -> None:
            if sink is not None:
                sink.close()
                whole = f"{base}/shard-{shard:08d}.bin"
                if files.get_file_info(whole).type != pafs.FileType.NotFound:
                    files.delete_file(whole)  # of an attempt that ended before its task did
                files.move(f"{base}/{name}", whole)

        for batch in batches:
            for number, slot, ids in zip(batch["shard"], batch["slot"], batch["ids"], strict=True):
                if number != shard:
                    close()
                    shard, sent, name = number, 0, f".{uuid.uuid4().hex}"
                    sink = files.open_output_stream(f"{base}/{name}")
                if slot != number * layout.shard_slots + sent or len(ids) != layout.stride:
                    raise RuntimeError(f"slot {slot} is out of order")
                sink.write(ids)
                sent += 1
            digests = [hashlib.sha256(ids).hexdigest() for ids in batch["ids"]]
            yield batch.drop(columns=["ids"]).assign(ids_sha256=digests)
        close()

    return write


_MANIFEST = (
    "slot long, seq long, shard long, byte_offset long, first_doc long, first_at long, "
    "n_docs long, n_ids long"
)


def materialise(
    docs: DataFrame, layout: Layout, root: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[str, DataFrame]:
    """Write ``docs`` as shards in training order; returns their folder and the manifest, one
    row a sequence: slot, seq (number before the permutation), shard, byte_offset, first_doc and
    first_at (the document its first id is of, and that id's place in it), n_docs, n_ids (those
    that are no filling) and ids_sha256.

    The texts of a partition follow each other, each ended by ``end_id``, cut every ``length``
    ids. Sequence k of n goes to slot permute(k, n). Shard s holds slots from s * shard_slots
    on, slot after slot of ``stride`` bytes, so a reader seeks to any slot and goes on from
    there. Neighbouring shards share a task where there are more than ``write_tasks``, so the number
    of tasks is bounded, and a task sorts its shards by spilling. The table is read twice, to count and to write, so it has to be a stored one that
    reads the same each time; a partition that does not stops the job. Only one number for
    each partition comes to the driver. A task that runs again writes the same shards, each
    under another name until it is whole.

    Null and empty texts give no ids; null ids stay null; repeated rows are repeated; other
    columns are not read; an empty table gives no shard.
    """
    spark = docs.sparkSession
    root = root or shared_path(spark, "training-order")
    texts = one_text(docs, id_col, text_col)
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = texts.where(F.col("text") != "")
    rows = texts.select("text").mapInArrow(_counter(layout), "part int, n long").collect()
    counts, offsets, n = {}, {}, 0
    for row in sorted(rows):
        counts[row["part"]], offsets[row["part"]] = row["n"], n
        n += row["n"]
    files, base = pafs.FileSystem.from_uri(root if "://" in root or root[:5] == "file:" else f"file://{root}")
    files.create_dir(base, recursive=True)
    uri = root if "://" in root or root[:5] == "file:" else f"file://{root}"
    made = texts.mapInPandas(
        _sequences(layout, offsets, counts, n),
        "slot long, seq long, first_doc long, first_at long, n_docs long, n_ids long, ids binary",
    )
    shard = F.floor(F.col("slot") / layout.shard_slots)
    made = made.withColumn("shard", shard).withColumn(
        "byte_offset", (F.col("slot") - F.col("shard") * layout.shard_slots) * layout.stride
    )
    names = [part.split()[0] for part in _MANIFEST.split(", ")]
    shards = max(1, -(-n // layout.shard_slots))
    each = -(-shards // layout.write_tasks)  # shards a task
    ranged = made.select(*names, "ids").repartitionById(
        -(-shards // each), F.floor(F.col("shard") / each).cast("int")
    )
    ranged = ranged.sortWithinPartitions("slot")
    path = f"{root.rstrip('/')}-manifest"
    ranged.mapInPandas(_writer(layout, uri), f"{_MANIFEST}, ids_sha256 string").write.parquet(path)
    return root, spark.read.schema(f"{_MANIFEST}, ids_sha256 string").parquet(path)


def read_slots(root: str, layout: Layout, first: int, many: int) -> Iterator[np.ndarray]:
    """Ids of ``many`` slots from ``first`` on, as a trainer that resumes there reads them."""
    uri = root if "://" in root or root[:5] == "file:" else f"file://{root}"
    files, base = pafs.FileSystem.from_uri(uri)
    slot = first
    while slot < first + many:
        shard, place = divmod(slot, layout.shard_slots)
        with files.open_input_file(f"{base}/shard-{shard:08d}.bin") as source:
            source.seek(place * layout.stride)
            for _ in range(min(layout.shard_slots - place, first + many - slot)):
                data = source.read(layout.stride)
                if len(data) < layout.stride:
                    return
                yield np.frombuffer(data, layout.ids)
                slot += 1
