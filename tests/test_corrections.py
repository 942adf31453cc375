"""Corrected past days, landing guards and side tables by themselves."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import frames
from frames import day
from shelfcast import schemas
from shelfcast.plans import corrections, jobs
from shelfcast.plans.features import feature_table
from shelfcast.schemas import FEATURES, SALES
from shelfcast.sources import tables, zones


def landed(spark, root, rows, days):
    """Zones with the given sales, side tables without plans, and features of the whole."""
    static = {
        "catalog": frames.catalog(spark, "a", "b"),
        "stores": frames.stores(spark, 1, 2),
        "markdowns": frames.markdowns(spark, [(3, "a", 1, 2.0, 1.0, 2.0)]),
        "discounts_history": frames.discounts(spark, [(4, "a", 1, 3.0, 1.0, 2.0)]),
        "price_history": frames.prices(spark),
    }
    tables.land_static(static, f"{root}/static")
    for n in days:
        land(spark, root, n, rows)
    jobs.build_features(spark, root)
    return static


def land(spark, root, n, rows):
    day_rows = frames.sales(spark, [r for r in rows if r[0] == n])
    return jobs.land_day(day_rows, f"{root}/sales", day(n), jobs.manifest_path(root, "sales"))


def as_built(spark, root, static):
    sales = zones.read_zone(spark, f"{root}/sales", SALES)
    names = ("catalog", "stores", "markdowns", "discounts_history")
    return feature_table(sales, *(static[n] for n in names))


def same(spark, root, static):
    got = zones.read_zone(spark, f"{root}/features", FEATURES).select(*schemas.FEATURE_COLUMNS)
    return sorted(map(tuple, got.collect())) == sorted(map(tuple, as_built(spark, root, static).collect()))


def files(root):
    found = {}
    for path in glob.glob(f"{root}/features/year=*/month=*/day=*/*.parquet"):
        found.setdefault(os.path.dirname(path), set()).add(os.path.basename(path))
    return found


def test_a_corrected_day_reaches_the_day_after(spark, tmp_path):
    """20 days of 1 unit; day 18 landed again with 100; the means of day 20 see it."""
    root = str(tmp_path / "z")
    rows = [(n, "a", 1, 1.0, 2.0) for n in range(20)]
    static = landed(spark, root, rows, range(20))
    land(spark, root, 18, [(18, "a", 1, 100.0, 2.0)])
    land(spark, root, 20, [(20, "a", 1, 1.0, 2.0)])
    assert not jobs._past_is_whole(spark, root, day(20))
    assert jobs.correct_features(spark, root, day(19)) == [day(18), day(19)]
    jobs.build_features(spark, root, day(20))
    zone = zones.between_dates(zones.read_zone(spark, f"{root}/features", FEATURES), day(20))
    assert zone.first()["rolling_mean_7_quantity"] == pytest.approx(106 / 7)
    assert same(spark, root, static) and jobs.correct_features(spark, root) == []


def test_a_day_alone_never_takes_a_stale_past(spark, tmp_path):
    root = str(tmp_path / "z")
    static = landed(spark, root, [(n, "a", 1, 1.0, 2.0) for n in range(20)], range(20))
    land(spark, root, 18, [(18, "a", 1, 100.0, 2.0)])
    land(spark, root, 20, [(20, "a", 1, 1.0, 2.0)])
    jobs.build_features(spark, root, day(20))
    zone = zones.between_dates(zones.read_zone(spark, f"{root}/features", FEATURES), day(20))
    assert zone.first()["rolling_mean_7_quantity"] == pytest.approx(106 / 7)
    assert not same(spark, root, static)


def test_rows_that_come_and_go_and_only_reached_dates(spark, tmp_path, monkeypatch):
    """Series with gaps; a date changes, one loses a row, one gains a series, one is new."""
    monkeypatch.setattr(corrections, "REACH", 30)
    monkeypatch.setattr("shelfcast.functions.series.LAGS", (7, 30))
    monkeypatch.setattr(schemas, "LAGS", (7, 30))
    root = str(tmp_path / "z")
    rows = [(n, i, s, float(n + s), 2.0) for n in range(60) for i in "ab" for s in (1, 2) if (n * s) % 5 and n != 13]
    real = corrections.series_columns

    def filled(*a):
        return {**real(*a), **{f"lag_{n}_quantity": F.lit(None).cast("double") for n in (90, 365)}}

    monkeypatch.setattr(corrections, "series_columns", filled)
    monkeypatch.setattr("shelfcast.plans.features.series_columns", filled)
    static = landed(spark, root, rows, range(60))
    before = files(root)
    land(spark, root, 6, [(6, "a", 1, 50.0, 9.0), (6, "a", 2, 8.0, 2.0), (6, "b", 2, 8.0, 2.0)])
    land(spark, root, 13, [(13, "a", 1, 4.0, 2.0)])
    land(spark, root, 11, [r for r in rows if r[0] == 11])
    touched = jobs.correct_features(spark, root)
    assert same(spark, root, static)
    assert {day(6), day(11), day(13)} <= set(touched) and touched[-1] < day(59)
    after = files(root)
    changed = {path for path in after if after[path] != before.get(path)}
    assert len(changed) == len(touched)


def test_a_price_alone_moves_one_date(spark, tmp_path):
    root = str(tmp_path / "z")
    rows = [(n, "a", 1, 1.0, 2.0) for n in range(12)]
    static = landed(spark, root, rows, range(12))
    land(spark, root, 5, [(5, "a", 1, 1.0, 7.5)])
    assert jobs.correct_features(spark, root) == [day(5)]
    assert same(spark, root, static)


def test_nothing_to_correct_without_features(spark, tmp_path):
    root = str(tmp_path / "z")
    land(spark, root, 1, [(1, "a", 1, 1.0, 2.0)])
    assert jobs.correct_features(spark, root) == []


def raw_files(folder, n_days=40, items=("a",)):
    folder.mkdir()
    lines = [f"{day(n)},{i},1.0,2.0,2.0,1" for n in range(n_days) for i in items]
    (folder / "sales.csv").write_text("date,item_id,quantity,price_base,sum_total,store_id\n" + "\n".join(lines) + "\n")
    catalog = "item_id,dept_name,class_name,subclass_name,item_type\n"
    (folder / "catalog.csv").write_text(catalog + "".join(f"{i},d,c,s,t\n" for i in items))
    prices = [f"{day(n)},{i},1,2.5" for n in range(n_days) for i in items]
    (folder / "price_history.csv").write_text("date,item_id,store_id,price\n" + "\n".join(prices) + "\n")
    return str(folder)


def test_an_empty_selection_leaves_zone_and_manifest(spark, tmp_path):
    raw, root = raw_files(tmp_path / "raw"), str(tmp_path / "z")
    jobs.land_history(spark, raw, root)
    sales, manifest = f"{root}/sales", jobs.manifest_path(root, "sales")
    before = zones.read_zone(spark, sales, SALES).count(), zones.read_manifest(spark, manifest).count()
    with pytest.raises(jobs.NothingToLand, match="as it was"):
        jobs.land_history(spark, raw, root, ["nobody has this"])
    after = zones.read_zone(spark, sales, SALES).count(), zones.read_manifest(spark, manifest).count()
    assert before == after and before[0] == 9
    assert [os.path.basename(p) for p in glob.glob(f"{root}/sales*")] == ["sales"]
    jobs.land_history(spark, raw, root)
    assert zones.last_version(spark, manifest) == 2


def test_side_tables_by_themselves(spark, tmp_path):
    raw, root = raw_files(tmp_path / "raw"), str(tmp_path / "z")
    jobs.land_history(spark, raw, root)
    new = tmp_path / "new"
    new.mkdir()
    (new / "catalog.csv").write_text("item_id,dept_name,class_name,subclass_name,item_type\na,d,c,s,t\nnew,d,c,s,t\n")
    (new / "price_history.csv").write_text(f"date,item_id,store_id,price\n{day(39)},a,1,9.0\n{day(41)},new,1,4.0\n")
    (new / "stores.csv").write_text("store_id,division,format,city,area\n")
    assert jobs.land_side_tables(spark, str(new), root) == ["catalog", "price_history"]
    prices = tables.read_static(spark, f"{root}/static", "price_history")
    found = {r["date"]: r["price"] for r in prices.collect()}
    assert len(found) == 41 and found[day(39)] == 9.0 and found[day(41)] == 4.0 and found[day(38)] == 2.5
    assert tables.read_static(spark, f"{root}/static", "catalog").count() == 2


def test_manifest_counts_up_and_is_made_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "RECORDS", 3)
    manifest = str(tmp_path / "m")
    for n in range(8):
        counts = spark.createDataFrame([(day(n % 5), n + 1)], "date date, n_rows long")
        assert zones.record_counts(counts, manifest, source=n) == n + 1
    found = {r["date"]: (r["n_rows"], r["version"], r["source"]) for r in zones.read_manifest(spark, manifest).collect()}
    assert found == {day(n): (rows, rows, rows - 1) for n, rows in zip(range(5), (6, 7, 8, 4, 5))}
    assert len(glob.glob(f"{manifest}/version=*")) <= 4
    gone = spark.createDataFrame([(day(0), 0)], "date date, n_rows long")
    zones.record_counts(gone, manifest)
    assert day(0) not in {r["date"] for r in zones.read_manifest(spark, manifest).collect()}
    none = spark.createDataFrame([], "date date, n_rows long")
    version = zones.record_counts(none, manifest)
    assert zones.record_counts(none, manifest, "overwrite") == version + 1
    assert zones.read_manifest(spark, manifest).isEmpty() and zones.last_version(spark, manifest) == version + 1
