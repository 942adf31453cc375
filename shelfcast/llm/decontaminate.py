"""Benchmark decontamination: one Aho-Corasick automaton over word windows of the test items."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import UPPER, written

# A word is a run of anything but the ASCII characters that are neither letter
# nor digit; A-Z count as a-z.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NODES = 10_000_000  # of an automaton, at most: characters times words of a window
_FOLD = bytes.maketrans(
    SEPARATORS + UPPER.encode(), b" " * len(SEPARATORS) + UPPER.lower().encode()
)
RESULT = (
    "n_words long, hit array<long>, items array<long>, spans array<struct<start:long,stop:long>>"
)


def normalised(text: str | None) -> str:
    """The words of a text, each with one space before and after."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    return f" {b' '.join(words).decode()} " if words else ""


def item_windows(text: str | None, size: int) -> list[str]:
    """All windows of ``size`` consecutive words; one of all words if there are fewer."""
    words = normalised(text).split()
    if not words:
        return []
    last = max(1, len(words) - size + 1)
    return [f" {' '.join(words[i : i + size])} " for i in range(last)]


def hit_spans(text: str, places: list[int]) -> list[tuple[int, int]]:
    """Spans in the original text of the words at some places, in order; words that follow each
    other share one."""
    spans: list[tuple[int, int]] = []
    last, wanted = -2, set(places)
    for at, word in enumerate(WORD.finditer(text)):
        if at in wanted:
            if at == last + 1:
                spans[-1] = (spans[-1][0], word.end())
            else:
                spans.append(word.span())
            last = at
    return spans


def _joined_spans(text: Column, places: Column) -> Column:
    @F.pandas_udf("array<struct<start:long,stop:long>>")
    def of(texts: pd.Series, places: pd.Series) -> pd.Series:
        rows = zip(texts, places, strict=True)
        found = (hit_spans(t, list(p)) if len(p) else [] for t, p in rows)
        return pd.Series([[{"start": a, "stop": b} for a, b in f] for f in found], dtype="object")

    return of(text, places)


class WindowScanner:
    """The automaton over the windows of many items. Windows end and begin in a space, so
    they match whole words only, and several items may own one window."""

    _last: tuple[str, WindowScanner] | None = None

    @classmethod
    def of(cls, key: str, items: list[tuple[int, str | None]], size: int) -> WindowScanner:
        """The scanner of a slice of items, built once in each worker process: tasks that follow
        take it from there, and another slice takes its place."""
        if cls._last is None or cls._last[0] != key:
            cls._last = None  # so that two are never held at once
            cls._last = (key, cls(items, size))
        return cls._last[1]

    def __init__(self, items: list[tuple[int, str | None]], size: int):
        owners: dict[str, set[int]] = {}
        for item, text in items:
            for window in item_windows(text, size):
                owners.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.automaton.add_word(window, (window.count(" ") - 1, sorted(ids)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[tuple[int, int]]]:
        """Number of words, places of the hit words, items found, spans of the hits in the
        original text (characters, end excluded; hits without a word between them are one)."""
        words = normalised(text)
        n_words = max(0, words.count(" ") - 1)
        if self.empty or not words:
            return n_words, [], [], []
        hit, items, place, seen = set(), set(), 0, 0
        for end, (n, ids) in self.automaton.iter(words):
            place += words.count(" ", seen, end)  # words that end before this last space
            seen = end
            hit.update(range(place - n, place))
            items.update(ids)
        if not hit:
            return n_words, [], [], []
        places = sorted(hit)
        return n_words, places, sorted(items), hit_spans(text, places)


def _slices(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> list[DataFrame]:
    """The items in as many slices as it takes for each to hold about ``most`` characters."""
    items = benchmark.select(
        F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").alias("text")
    ).where(F.col("item").isNotNull() & F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // most) or 1
    part = F.pmod(F.xxhash64("item"), F.lit(n))
    return [items.where(part == i) if n > 1 else items for i in range(n)]


def _scanner(shared, size: int):
    key = uuid.uuid4().hex

    @F.pandas_udf(RESULT)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = WindowScanner.of(key, shared.value, size)
        for batch in texts:
            rows = [scanner.scan(t) for t in batch]
            yield pd.DataFrame(
                {
                    "n_words": pd.Series([r[0] for r in rows], dtype="int64"),
                    "hit": [r[1] for r in rows],
                    "items": [r[2] for r in rows],
                    "spans": [[{"start": a, "stop": b} for a, b in r[3]] for r in rows],
                }
            )

    return scan


def scan_columns(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    slice_chars: int = 1_000_000,
    name: str = "contamination",
) -> DataFrame:
    """``docs`` with all columns and a struct column ``name``: n_words, hit (places of the words
    inside any window of an item), items (ids, sorted), spans (of hits in the original text).

    A benchmark of up to ``slice_chars`` characters is one automaton, and documents are scanned
    once. A larger one is cut into slices of about that size, or less for longer windows: a
    character is in up to ``size`` windows, and a slice has at most about ``NODES`` nodes (some 55
    bytes each) and one item. Each is a scan of its own, whose result is written before the next
    automaton takes its place; hits of all slices are joined. So what is broadcast at once and
    what a worker holds are bounded, and no item is left out.

    Null and empty texts have no words; a null item id or text is no item; an empty benchmark
    finds nothing. A column named ``name`` already is replaced.
    """
    spark = docs.sparkSession
    work, parts = docs.drop(name), []
    base = work.columns
    most = max(1, min(slice_chars, NODES // size))
    slices = _slices(benchmark, item_col, item_text_col, most)
    for n, items in enumerate(slices):
        rows = [(r["item"], r["text"]) for r in items.toLocalIterator()]
        shared = spark.sparkContext.broadcast(rows)

        parts.append(f"{name}__{n}")
        work = work.withColumn(parts[-1], _scanner(shared, size)(F.col(f"`{text_col}`")))
        if len(slices) > 1:
            work = written(work, "scanned")
            shared.unpersist()
    if len(parts) == 1:
        return work.withColumnRenamed(parts[0], name)
    union = {
        field: F.array_sort(reduce(F.array_union, [F.col(f"`{p}`.{field}") for p in parts]))
        for field in ("hit", "items")
    }
    found = F.struct(
        F.col(f"`{parts[0]}`.n_words").alias("n_words"),
        union["hit"].alias("hit"),
        union["items"].alias("items"),
        _joined_spans(F.col(f"`{text_col}`"), union["hit"]).alias("spans"),
    )
    return work.select(*[F.col(f"`{c}`") for c in base], found.alias(name))

