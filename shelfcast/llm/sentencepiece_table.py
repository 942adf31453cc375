"""SentencePiece by a distinct-chunk table: each distinct marked word is segmented once."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import one_text

MARK = "▁"
_CHUNK = re.compile(f"{MARK}(?:{MARK}*[^{MARK}]+|{MARK}*$)")
BLOCK_CHARS = 16_000_000
PART_BYTES = 256 << 20  # of text for each task that segments chunks or joins blocks


@cache
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def chunkable(model: str) -> bool:
    """Whether pieces cannot cross the markers: no piece holds one after another character,
    blanks are kept as they are, and a text begins with a marker of its own."""
    sp = processor(model)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    if any(crossing.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        return False
    probe = "a  b ﬁ　c D "
    return sp.decode(sp.encode(probe)) == probe and sp.id_to_piece(sp.encode("a")[0])[0] == MARK


def chunks(text: str) -> list[str]:
    """The marked words of a text, each without its first marker; none of an empty text."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    if marked[0] != MARK and marked[-1] != MARK and MARK + MARK not in marked:
        return marked.split(MARK)
    return [c[1:] for c in _CHUNK.findall(MARK + marked)]


def segment(words: list[str], model: str) -> list[list[int]]:
    """Ids of marked words, each given without its first marker, which the library adds."""
    sp = processor(model)
    found = sp.encode(words, num_threads=1)
    if "" in words:
        alone = [sp.piece_to_id(MARK)]
        found = [ids if word else alone for word, ids in zip(words, found, strict=True)]
    return found


def varint(values: np.ndarray) -> bytes:
    """Non-negative numbers below 2 ** 35, seven bits a byte, small ones in one byte."""
    values = np.asarray(values, dtype=np.int64)
    width = 1 + sum((values >= 1 << s).astype(np.int64) for s in (7, 14, 21, 28))
    start = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), dtype=np.uint8)
    for i in range(5):
        has = width > i
        more = (width[has] > i + 1).astype(np.uint8) << 7
        out[start[has] + i] = ((values[has] >> (7 * i)) & 127).astype(np.uint8) | more
    return out.tobytes()


def unvarint(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.r_[0, ends[:-1] + 1]
    out = np.zeros(len(ends), dtype=np.int64)
    for i in range(5):
        has = starts + i <= ends
        out[has] |= (raw[starts[has] + i].astype(np.int64) & 127) << (7 * i)
    return out


def packed(data: bytes) -> bytes:
    """Entropy coding takes off what the shuffle's own compression leaves in words and ids."""
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int):
    """Cut the documents of a partition into blocks: (block, ids, chunk counts, places, words).
    Places number the distinct chunks of the block, frequent ones first."""
    part, number = TaskContext.get().partitionId(), 0
    known: dict[str, int] = defaultdict()
    known.default_factory = known.__len__
    ids: list[int | None] = []
    places: list[np.ndarray] = []
    chars = 0

    def close():
        every = np.concatenate(places)
        often = np.bincount(every, minlength=len(known))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        words = list(known)
        block = (part << 32) | number
        return block, ids, [len(p) for p in places], rank[every], [words[i] for i in order.tolist()]

    for batch in batches:
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            found = chunks(text)
            ids.append(ident)
            places.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
            chars += len(text)
            if chars >= block_chars:
                yield close()
                known.clear()
                ids, places, chars, number = [], [], 0, number + 1
    if ids:
        yield close()


def _mark_of(words: list[str]) -> int:
    """63 bits that stand for the words of a block in their order."""
    return int.from_bytes(hashlib.sha256(" ".join(words).encode()).digest()[:8], "big") >> 1


def _position_rows(block_chars: int):
    def run(batches):
        for block, ids, counts, places, words in _blocks(batches, block_chars):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([_mark_of(words)], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([varint(np.array(counts))], pa.binary()),
                    pa.array([packed(varint(places))], pa.binary()),
                ],
                ["block", "mark", "ids", "counts", "places"],
            )

    return run


def _word_rows(block_chars: int, parts: int):
    from zlib import crc32

    def run(batches):
        for block, _, _, _, words in _blocks(batches, block_chars):
            mark = _mark_of(words)
            part = np.fromiter((crc32(w.encode()) % parts for w in words), np.int64, len(words))
            order = np.argsort(part, kind="stable")
            cuts = np.r_[0, np.flatnonzero(np.diff(part[order])) + 1, len(order)].tolist()
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                own = sorted(order[a:b].tolist(), key=words.__getitem__)
                text = " ".join(words[i] for i in own).encode()
                places = packed(varint(np.array(own)))
                rows.append((int(part[own[0]]), block, mark, places, packed(text)))
            if rows:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_WORDS.names, r, strict=True)) for r in rows], schema=_WORDS
                )

    return run


_WORDS = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("mark", pa.int64()), ("places", pa.binary()), ("words", pa.binary())]
)
_IDS = pa.schema(
    [("block", pa.int64()), ("mark", pa.int64()), ("places", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary())]
)


def id_type(model: str) -> type[np.unsignedinteger]:
    """The narrowest type that holds every id of a model."""
    return np.uint16 if processor(model).get_piece_size() <= 1 << 16 else np.uint32


def _segmenter(model: str, kind: type[np.unsignedinteger]):
    wide = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["part"] != now:  # a chunk is of one part, so the table starts anew
                    now, table = row["part"], {}
                words = unpacked(row["words"]).decode().split(" ")
                fresh = [w for w in words if w not in table]
                for word, ids in zip(fresh, segment(fresh, model), strict=True):
                    table[word] = np.array(ids, dtype=kind).tobytes()
                found = [table[w] for w in words]
                lengths = packed(varint(np.fromiter(map(len, found), np.int64, len(found)) // wide))
                ids = packed(b"".join(found))
                fields = (row["block"], row["mark"], row["places"], lengths, ids)
                out.append(dict(zip(_IDS.names, fields, strict=True)))
            yield pa.RecordBatch.from_pylist(out, schema=_IDS)

    return run


FIELDS = {
    "n_tokens": pa.int64(),
    "ids": pa.list_(pa.int32()),
    "decoded": pa.string(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
_DDL = {
    "n_tokens": "long", "ids": "array<int>", "decoded": "string",
    "ids_sha256": "string", "decoded_sha256": "string",
}


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one run after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class _Table:
    """Ids of the distinct chunks of one block, by place."""

    def __init__(self, parts: pa.Table, mark: int, kind: type[np.unsignedinteger]):
        if any(m != mark for m in parts["mark"].to_pylist()):
            raise RuntimeError("the documents changed between two readings")
        columns = [
            [read(unpacked(blob.as_py())) for blob in parts[name]]
            for name, read in (
                ("places", unvarint),
                ("lengths", unvarint),
                ("ids", lambda data: np.frombuffer(data, kind)),
            )
        ]
        places, lengths, ids = (np.concatenate(c) if c else np.empty(0, np.int64) for c in columns)
        self.lengths = np.zeros(len(places), dtype=np.int64)
        self.lengths[places] = lengths
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.zeros(len(ids), dtype=kind)
        self.flat[_spread(self.starts[places], lengths)] = ids

    def ids(self, places: np.ndarray) -> np.ndarray:
        return self.flat[_spread(self.starts[places], self.lengths[places])]

    def each(self, make, step: int = 20_000) -> list[str]:
        """``make`` of the ids of some chunks at a time, for all chunks."""
        out: list[str] = []
        for at in range(0, len(self.lengths), step):
            ends = (self.starts + self.lengths)[at : at + step].tolist()
            starts = self.starts[at : at + step].tolist()
            out += make([self.flat[a:b].tolist() for a, b in zip(starts, ends, strict=True)])
        return out


def _joiner(model: str, want: tuple[str, ...], kind: type[np.unsignedinteger]):
    schema = pa.schema([("doc_id", pa.int64()), *[(w, FIELDS[w]) for w in want]])

    def digests(words: list[str], between: str, docs: list[np.ndarray]) -> list[str]:
        joined = (between.join(map(words.__getitem__, d.tolist())) for d in docs)
        return [hashlib.sha256(text.encode()).hexdigest() for text in joined]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row in left.to_pylist():
            table = _Table(right, row["mark"], kind)
            places = unvarint(unpacked(row["places"]))
            ends = np.cumsum(unvarint(row["counts"]))
            docs = np.split(places, ends[:-1])
            columns: dict[str, object] = {"doc_id": pa.array(row["ids"], pa.int64())}
            if "n_tokens" in want:
                columns["n_tokens"] = [int(table.lengths[d].sum()) for d in docs]
            if "ids" in want:
                after = np.r_[0, np.cumsum(table.lengths[places])][np.r_[0, ends]]
                values = pa.array(table.ids(places).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(pa.array(after.astype(np.int32)), values)
            if "ids_sha256" in want:
                words = table.each(lambda part: [",".join(map(str, ids)) for ids in part])
                columns["ids_sha256"] = digests(words, ",", docs)
            if {"decoded", "decoded_sha256"} & {*want}:
                words = table.each(lambda part: processor(model).decode(part, num_threads=1))
                if "decoded" in want:
                    texts = (map(words.__getitem__, d.tolist()) for d in docs)
                    columns["decoded"] = [" ".join(text) for text in texts]
                if "decoded_sha256" in want:
                    columns["decoded_sha256"] = digests(words, " ", docs)
            tables.append(pa.table({f.name: columns[f.name] for f in schema}, schema=schema))
        return pa.concat_tables(tables) if tables else schema.empty_table()

    return run


def encode_documents(
    docs: DataFrame,
    model: str,
    want: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    parts: int | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """doc_id and the fields wanted of each document: ids as the library encodes the whole
    text, and what it decodes from them.

    The documents of a partition are taken in blocks of about ``block_chars``. Each block sends
    its distinct chunks to the part of the chunk table that owns them, where each is segmented
    once for the whole corpus, and its documents as places in the list of its chunks; ids and
    places meet again by block. So texts never move, a chunk is sent once for each block it is
    in however often that holds it, and no task holds more than a block or a part of the table.
    There is a part, and a task that joins blocks, for each ``part_bytes`` of text, and as many
    as the session has shuffle partitions at least. The table is read three times, for its size,
    for chunks and for places: it has to be a stored one that reads the same each time, and
    blocks whose readings differ stop the job.

    Null and empty texts have no ids; null ids stay null; repeated rows are repeated; other
    columns are not read; an empty table gives an empty result. A model whose pieces can cross
    markers is refused.
    """
    if not chunkable(model):
        raise ValueError("pieces of this model can cross whitespace markers")
    spark = docs.sparkSession
    texts = one_text(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    parts, kind = parts or 4 * tasks, id_type(model)
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    words = texts.mapInArrow(
        _word_rows(block_chars, parts),
        "part int, block long, mark long, places binary, words binary",
    )
    segmented = (
        words.repartition(tasks, "part")
        .sortWithinPartitions("part", "block")
        .mapInArrow(
            _segmenter(model, kind),
            "block long, mark long, places binary, lengths binary, ids binary",
        )
    )
    positions = texts.mapInArrow(
        _position_rows(block_chars),
        "block long, mark long, ids array<long>, counts binary, places binary",
    )
    ddl = ", ".join(["doc_id long", *[f"{w} {_DDL[w]}" for w in want]])
    return (
        positions.repartition(tasks, "block")
        .groupBy("block")
        .cogroup(segmented.repartition(tasks, "block").groupBy("block"))
        .applyInArrow(_joiner(model, want, kind), ddl)
    )
