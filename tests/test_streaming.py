"""Landing files as a stream: restarts, repeated and late files, failures half-way."""

import datetime as dt
from pathlib import Path

import pytest

import frames
from frames import day
from shelfcast import schemas
from shelfcast.plans import jobs
from shelfcast.plans.features import feature_table
from shelfcast.schemas import FEATURES, SALES
from shelfcast.sources import tables, zones
from shelfcast.streaming import landing

HEADER = ",".join(SALES.names)


def put(folder, name, rows):
    """rows: (day number, item, store, quantity)."""
    lines = [f"{day(n)},{i},{q},2.0,{q * 2},{s}" for n, i, s, q in rows]
    (folder / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")


def run(spark, inbox, root, **options):
    landing.land_stream(spark, str(inbox), root, **options).awaitTermination()


def landed(spark, root):
    zone = zones.read_zone(spark, f"{root}/sales", SALES)
    return sorted((r["date"], r["item_id"], r["store_id"], r["quantity"]) for r in zone.collect())


def expected(*files):
    return sorted((day(n), i, s, float(q)) for rows in files for n, i, s, q in rows)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


def test_same_zone_as_the_batch_job(spark, inbox, tmp_path):
    """History by the batch job, then files: one of a new day, one late, one again under another
    name, one of a date that the history has; features as a full build gives them."""
    root = str(tmp_path / "z")
    history = [(n, "a", 1, float(n % 5 + 1)) for n in range(12)]
    static = {
        "catalog": frames.catalog(spark, "a", "b"),
        "stores": frames.stores(spark, 1, 2),
        "markdowns": frames.markdowns(spark),
        "discounts_history": frames.discounts(spark),
    }
    tables.land_static(static, f"{root}/static")
    sales = frames.sales(spark, [(*r, 2.0) for r in history])
    zones.write_by_date(sales, f"{root}/sales", padded=True)
    zones.record_dates(zones.read_zone(spark, f"{root}/sales", SALES), jobs.manifest_path(root, "sales"))
    jobs.build_features(spark, root)

    new, late, old = [(12, "a", 1, 4.0), (13, "a", 1, 4.0)], [(12, "b", 2, 9.0)], [(5, "b", 1, 3.0)]
    put(inbox, "new", new)
    run(spark, inbox, root)
    put(inbox, "late", late)
    put(inbox, "new delivered again", new[::-1])
    put(inbox, "old", old)
    run(spark, inbox, root, files_at_once=1)
    run(spark, inbox, root)
    assert landed(spark, root) == expected(history, new, late, old)
    zone = zones.read_zone(spark, f"{root}/sales", SALES)
    want = feature_table(zone, *static.values())
    got = zones.read_zone(spark, f"{root}/features", FEATURES).select(*schemas.FEATURE_COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    manifest = zones.read_manifest(spark, jobs.manifest_path(root, "sales"))
    assert {r["date"]: r["n_rows"] for r in manifest.collect()}[day(12)] == 2


def test_a_batch_that_failed_is_run_again(spark, inbox, tmp_path, monkeypatch):
    """It fails once its rows are landed and before they are recorded; run again nothing doubles,
    also not what a date had before its first file."""
    root = str(tmp_path / "z")
    jobs.land_day(frames.sales(spark, [(1, "a", 1, 7.0, 2.0)]), f"{root}/sales", day(1), jobs.manifest_path(root, "sales"))
    put(inbox, "one", [(1, "a", 2, 3.0), (2, "a", 1, 3.0)])

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(landing, "record_dates", fails)
        with pytest.raises(Exception, match="lost"):
            run(spark, inbox, root, build=False)
    run(spark, inbox, root, build=False)
    assert landed(spark, root) == expected([(1, "a", 1, 7.0), (1, "a", 2, 3.0), (2, "a", 1, 3.0)])
    put(inbox, "empty", [])
    run(spark, inbox, root, build=False)
    assert len(landed(spark, root)) == 3


def test_copies_within_a_batch_count_once(spark, inbox, tmp_path):
    root = str(tmp_path / "z")
    put(inbox, "x", [(1, "a", 1, 3.0), (1, "a", 1, 3.0)])
    put(inbox, "y", [(1, "a", 1, 3.0), (1, "a", 1, 3.0)])
    put(inbox, "z", [(1, "a", 1, 3.0)])
    run(spark, inbox, root, build=False)
    assert landed(spark, root) == expected([(1, "a", 1, 3.0)] * 3)


def test_query_of_the_stream_lands_files_of_many_tasks(spark, monkeypatch):
    """The second copy of a file counts once, whichever task wrote it."""
    from checks import queries

    start = dt.date(1999, 1, 1)
    data = [(start + dt.timedelta(days=9 * d), i, 1.0, 2.0, 2.0, s) for d in range(80) for i in "ab" for s in (1, 7)]
    sales = spark.createDataFrame(data + data[-3:], SALES)
    files = []
    real = queries.tables.write_csv

    def write_csv(df, path):
        real(df, path)
        files.append(sum(f.suffix == ".csv" for f in Path(path).iterdir()))

    monkeypatch.setattr(queries.tables, "write_csv", write_csv)
    monkeypatch.setattr(queries, "Retail", lambda *_: type("R", (), {"sales": lambda self: sales})())
    found = queries.ingest_stream(spark, "")
    want = sales.groupBy("date").count().collect()
    assert {r["date"]: (r["n_rows"], r["units"]) for r in found.collect()} == {str(r[0]): (r[1], r[1]) for r in want}
    assert len(files) == 4 and min(files) > 1
