import random
from collections import defaultdict

from shelfcast.llm.line_dedup import HASH, LineRuns, dedup_lines, line_hashes
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for ident, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(-1 if ident is None else ident)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for ident, text in rows:
        lines = (text or "").split("\n")
        me = -1 if ident is None else ident
        keep = [x for x in lines if hot.get(x.strip(BLANKS).translate(LOWER), me) == me]
        out.append((ident, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def run(docs, **params):
    found = dedup_lines(docs, **params).select("doc_id", "deduped.*")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_random_documents_agree_with_brute_force(docs_of):
    rng = random.Random(3)
    pool = [f"{'É' if i % 3 else 'E'} line number {i} with some words" for i in range(40)] + ["short", ""]
    rows = []
    for ident in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(8))]
        lines = [rng.choice([x, x.upper(), f"\t{x} \r", f" {x}"]) for x in lines]
        rows.append((ident, "\n".join(lines)))
    rng.shuffle(rows)
    want = brute(rows)
    assert any(r[2] for r in want)
    for batches, fanout in ((1, 2), (4, 2), (7, 3)):
        assert run(docs_of(rows), batches=batches, fanout=fanout) == want


def test_edges(docs_of):
    long = "a line that stands in a good many documents"
    rows = [
        (None, long), (None, None), (1, None), (2, ""), (3, long), (4, f"{long}\n{long}"),
        (4, f"{long}\n{long}"), (5, "\n\n"), (6, long + "\nown words of this very document\n" + long),
        (7, "x" * 300_000 + "\n" + long),
    ]
    assert run(docs_of(rows)) == brute(rows)


def test_every_line_of_a_document_may_go(docs_of):
    text = "the same long line in all of them"
    found = run(docs_of([text] * 5))
    assert [r[2] for r in found] == [1, 1, 1, 1, 0]
    assert [r[3] for r in found] == ["", "", "", "", text]


def test_two_documents_are_not_enough_and_short_lines_stay(docs_of):
    rows = [(1, "twenty characters ok!"), (2, "twenty characters ok!"), *[(i, "short") for i in range(3, 9)]]
    assert all(r[2] == 0 for r in run(docs_of(rows)))


def test_empty_table_and_other_columns(docs_of):
    clash = docs_of(["a", "b"], id="1", pos="2", lines="3", deduped="4", row="5", text_hash="6", gone="7")
    assert dedup_lines(clash).count() == 2
    assert set(dedup_lines(clash).columns) == set(clash.columns)
    assert dedup_lines(docs_of([("x", "y")][:0])).collect() == []


def test_native(docs_of):
    plan = dedup_lines(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_compact_and_leave_settled_keys_out(spark):
    runs = LineRuns(spark, min_docs=2, fanout=2, buckets=2)

    def batch(ids):
        rows = spark.createDataFrame([(i, "same") for i in ids] + [(i, f"own {i}") for i in ids], "id long, k string")
        return rows.select("id", *line_hashes(F.col("k")))

    runs.add(batch([9, 8]))
    assert [len(level) for level in runs.levels] == [1]
    runs.add(batch([7]))  # "same" is settled: only its own line is added
    assert [len(level) for level in runs.levels] == [0, 1]
    (merged,) = runs.runs()
    assert merged.count() == 4
    runs.add(batch([5]))
    assert [len(level) for level in runs.levels] == [1, 1]
    (row,) = runs.repeated().collect()
    assert row["max_id"] == 9
    joined = runs.runs()[0].hint("merge").join(runs.runs()[1], HASH)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_no_run_stays_in_the_catalog(spark, docs_of):
    rows = [(i, f"a line that stands in many documents\nline of document number {i}") for i in range(40)]
    before = {t.name for t in spark.catalog.listTables()}
    assert run(docs_of(rows), batch_docs=7) == brute(rows)
    assert {t.name for t in spark.catalog.listTables()} == before
