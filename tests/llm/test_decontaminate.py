import random
import re

from shelfcast.llm import decontaminate
from shelfcast.llm.decontaminate import WindowScanner, item_windows, scan_columns

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, size):
    own, hit, found = words(text), set(), set()
    for ident, item in items:
        w = words(item)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(ident)
    return len(own), sorted(hit), sorted(found)


def cases(seed=1):
    rng = random.Random(seed)
    vocabulary = ["a", "aa", "É", "b1", "the", "x-y", "Ü", "ß", "9"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " -- "]) for _ in range(n))

    items = [(i, text(rng.randrange(0, 9))) for i in range(25)]
    docs = [text(rng.randrange(0, 40)) for _ in range(60)]
    docs += [f"{text(3)} {items[i][1].upper()} {text(3)}" for i in range(25)]
    return items, docs


def test_scanner_agrees_with_brute_force():
    items, docs = cases()
    for size in (1, 3, 5):
        scanner = WindowScanner(items, size)
        for text in docs:
            n, hit, found, spans = scanner.scan(text)
            assert (n, hit, found) == brute(text, items, size)
            inside = [w for a, b in spans for w in words(text[a:b])]
            assert inside == [words(text)[i] for i in hit]


def test_windows():
    assert item_windows("One, two!", 10) == [" one two "]
    assert item_windows("a b c", 2) == [" a b ", " b c "]
    assert item_windows(" ?! ", 10) == [] and item_windows(None, 10) == []


def test_slices_and_rows(spark, docs_of):
    items, docs = cases(5)
    docs += [None, "", "word " * 40_000]
    bench = spark.createDataFrame([*items, (None, "a aa"), (99, None), (3, items[3][1])], "item_id long, text string")
    frame = docs_of(docs, hit="1", n_words="2", contamination="3")
    want = {i: brute(t, items, 3) for i, t in enumerate(docs[:-1])}
    for most in (16_000_000, 200):
        found = scan_columns(frame, bench, size=3, slice_chars=most)
        assert set(found.columns) == set(frame.columns)
        rows = {r.doc_id: r.contamination for r in found.collect()}
        assert {i: (rows[i].n_words, rows[i].hit, rows[i].items) for i in want} == want
        assert rows[len(docs) - 1].n_words == 40_000
        for i in want:
            inside = [w for s in rows[i].spans for w in words(docs[i][s.start : s.stop])]
            assert inside == [words(docs[i])[k] for k in rows[i].hit]


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    (row,) = scan_columns(docs_of(["a b"]), bench).collect()
    assert row.contamination.n_words == 2 and row.contamination.hit == []
    full = spark.createDataFrame([(1, "a b")], bench.schema)
    assert scan_columns(docs_of([("x", "y")][:0]), full).collect() == []


def test_slices_are_bounded_by_nodes(spark, docs_of, monkeypatch):
    items, docs = cases(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = scan_columns(docs_of(docs), bench, size=3).orderBy("doc_id").collect()
    monkeypatch.setattr(decontaminate, "NODES", 600)  # 200 characters of windows of three words
    made = decontaminate._slices(bench, "item_id", "text", 200)
    assert len(made) > 1 and sum(s.count() for s in made) == len(items)
    assert scan_columns(docs_of(docs), bench, size=3).orderBy("doc_id").collect() == want


def test_one_scanner_a_process():
    items, _ = cases()
    one = WindowScanner.of("first", items, 3)
    assert WindowScanner.of("first", items, 3) is one
    assert WindowScanner.of("second", items, 3) is not one
