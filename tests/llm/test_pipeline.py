import re

import pytest
import sentencepiece
import zlib

import __spark_entry__
import corpus_pipeline
from shelfcast.llm.decontaminate import WindowScanner
from shelfcast.llm.line_dedup import dedup_lines
from shelfcast.llm.quality import Ftrl, score, train
from shelfcast.llm.queries import PIECES, QUERIES
from shelfcast.llm.simhash import fingerprint
from shelfcast.llm.sql import ORACLES
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import components

SF = "/root/testdata/sf0.001"


def test_entry_points_name_the_queries():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    names = [n for n in QUERIES if n != "pipeline"]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_other_queries_run(spark, name):
    table = {"op1": "pages", "op8": None}.get(name.split("_")[0], "documents")
    rows = QUERIES[name](spark, SF).count()
    n = spark.read.parquet(f"{SF}/{table}.parquet").count() if table else 0
    assert rows == 2 * n if table == "pages" else rows >= n


def test_pipeline_agrees_with_brute_force(spark):
    """The same stages over rows in memory; the weights are those of the same sample."""
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    order = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()
    rank = {r.doc_id: r.h for r in order}
    learn = sorted((rank[i], i, t, labels[i]) for i, t in documents if i in labels and zlib.crc32(str(i).encode()) % 5)
    params = Ftrl()
    weights = train([(t, y) for *_, t, y in learn], params)
    kept = [(i, t) for i, t in documents if score(t, weights, params.bits) >= 0.3]
    kept = [(i, t) for i, _, _, t in brute_lines(kept)]
    prints = {i: fingerprint(t) for i, t in kept}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if b < a and (prints[a] ^ prints[b]).bit_count() <= 4]
    lead = components(links, ids)
    kept = [(i, t) for i, t in kept if lead[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    scanner = WindowScanner(items, 10)
    kept = [(i, t) for i, t in kept if not scanner.scan(t)[1]]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted((i, sp.encode(t)) for i, t in kept)
    got = sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert [i for i, _ in got] == [i for i, _ in want] and got == want
    assert 0 < len(want) < len(documents)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, extra columns, and an empty table."""
    sf = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, id long"
    rows = [
        (None, None, None, None, None, 1, 1), (1, "a b c d", "en", "s", 7, 1, 1), (1, "a b c d", "en", "s", 7, 1, 1),
        (2, "", None, "s", 0, None, None), (3, None, "en", None, None, 1, 1), (4, "word " * 60_000, "en", "s", 300_000, 1, 1),
    ]
    spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "sentencepiece":
                assert out.columns == docs.columns, name
            assert out.count() <= len(part)


def test_line_stage_keeps_null_texts(spark):
    docs = spark.createDataFrame([(1, None, 5)], "doc_id long, text string, n_chars int")
    assert [tuple(r) for r in corpus_pipeline.lines(spark, docs, SF).collect()] == [(1, None, None)]
    assert dedup_lines(docs).first().deduped.n_lines == 1

