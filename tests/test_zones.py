import glob

import pytest
from pyspark.sql import functions as F

import frames
from frames import day
from shelfcast import schemas
from shelfcast.plans import jobs
from shelfcast.plans.features import feature_table
from shelfcast.sources import tables, zones
from shelfcast.sources.workspace import SETTING, fresh_directory
from test_operators import plan, rows


def one_day(spark, n, quantity=1.0, items=("a", "b")):
    return frames.sales(spark, [(n, i, 1, quantity, 2.0) for i in items])


def test_running_a_day_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "sales")
    both = one_day(spark, 0).unionByName(one_day(spark, 1))
    zones.write_by_date(both, path, padded=True)
    for _ in range(2):
        jobs.land_day(one_day(spark, 1, 5.0), path, day(1))
    zone = zones.read_zone(spark, path)
    assert rows(zone, "date", "quantity") == [(day(0), 1.0)] * 2 + [(day(1), 5.0)] * 2
    assert glob.glob(f"{path}/year=2024/month=01/day=02/*.parquet")


def test_modes(spark, tmp_path):
    path = str(tmp_path / "zone")
    zones.write_by_date(one_day(spark, 0), path)
    zones.write_by_date(one_day(spark, 0), path, mode="append")
    assert zones.read_zone(spark, path).count() == 4
    zones.write_by_date(one_day(spark, 3), path, mode="overwrite")
    assert rows(zones.read_zone(spark, path), "date") == [(day(3),)] * 2
    assert glob.glob(f"{path}/year=2024/month=1/day=4/*.parquet")
    with pytest.raises(ValueError):
        zones.write_by_date(one_day(spark, 0), path, mode="ignore")


def test_a_day_without_rows_leaves_the_zone_alone(spark, tmp_path):
    path = str(tmp_path / "zone")
    zones.write_by_date(one_day(spark, 0), path)
    jobs.land_day(one_day(spark, 0), path, day(9))
    assert zones.read_zone(spark, path).count() == 2


def test_a_hot_date_is_cut_into_several_tasks(spark, tmp_path):
    """One date holds most rows; it must not be written by one task."""
    path = str(tmp_path / "zone")
    lines = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, F.date_add(F.lit(day(0)), (F.col("id") / 10 % 5).cast("int")))
        .otherwise(F.lit(day(7)))
        .alias("date"),
        F.xxhash64("id").cast("string").alias("item_id"),
        F.lit(1).alias("store_id"),
        F.rand(1).alias("quantity"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1MB")
    try:
        zones.write_by_date(lines, path)
    finally:
        spark.conf.unset(setting)
    assert len(glob.glob(f"{path}/year=2024/month=1/day=8/*.parquet")) > 2
    assert zones.read_zone(spark, path).count() == 300_000
    hot = zones.partition_row_count(zones.read_zone(spark, path), day(7)).first()[0]
    assert hot == 270_000


def test_window_prunes_partitions_and_missing_dates_are_just_absent(spark, tmp_path):
    path = str(tmp_path / "zone")
    zones.write_by_date(
        one_day(spark, 0).unionByName(one_day(spark, 2)).unionByName(one_day(spark, 9)), path
    )
    window = zones.between_dates(zones.read_zone(spark, path), day(0), day(5))
    assert rows(window.distinct(), "date") == [(day(0),), (day(0),), (day(2),), (day(2),)]
    text = plan(zones.between_dates(zones.read_zone(spark, path), day(0), day(5)))
    assert "make_date" in text.split("PartitionFilters")[1].split("\n")[0]
    assert "GreaterThanOrEqual(date,2024-01-01)" in text.split("PushedFilters")[1].split("\n")[0]


def test_manifest_follows_the_zone_and_opens_none_of_its_files(spark, tmp_path):
    path, manifest = str(tmp_path / "zone"), str(tmp_path / "manifest")
    assert zones.read_manifest(spark, manifest).isEmpty()
    zones.write_by_date(one_day(spark, 4).unionByName(one_day(spark, 2)), path, padded=True)
    zones.record_dates(zones.read_zone(spark, path), manifest)
    assert jobs.land_day(one_day(spark, 5, items="abc"), path, day(5), manifest) == 3
    assert jobs.land_day(one_day(spark, 5, items="a"), path, day(5), manifest) == 1  # run again
    assert jobs.land_day(one_day(spark, 5), path, day(9), manifest) == 0
    found = zones.read_manifest(spark, manifest)
    in_zone = zones.read_zone(spark, path).groupBy("date").count()
    assert rows(found, "date", "n_rows") == rows(in_zone)
    assert zones.last_date(found).first()[0] == day(5)
    assert path not in plan(zones.next_dates(found))
    assert tuple(zones.next_dates(found).first()) == (day(6), day(7))
    zones.remove_dates(spark, path, [day(4)])
    assert rows(zones.read_zone(spark, path), "date") == [(day(2),), (day(2),), (day(5),)]


def test_manifest_is_in_date_order(spark):
    both = one_day(spark, 3).unionByName(one_day(spark, 1, items="a"))
    assert [tuple(r) for r in zones.partition_manifest(both).collect()] == [
        (day(1), "year=2024/month=01/day=02", 1),
        (day(3), "year=2024/month=01/day=04", 2),
    ]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "Unnamed: 0,store_id,date,item_id,sum_total,quantity,price_base,extra\n"
        "0,1,2024-01-01,abc,6.0,2,3.0,x\n"
        "1,2,2024-01-02,0012,,,,y\n"
    )
    df = tables.read_csv(spark, str(path), schemas.SALES)
    assert df.schema == schemas.SALES
    assert sorted(map(tuple, df.collect())) == [
        (day(0), "abc", 2.0, 3.0, 6.0, 1),
        (day(1), "0012", None, None, None, 2),
    ]
    kept = tables.read_csv(spark, str(path), schemas.SALES, keep_rest=True)
    assert kept.columns == [*schemas.SALES.names, "extra"]


def test_csv_files_with_other_headers_never_swap_columns(spark, tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()
    (folder / "1.csv").write_text(
        "date,item_id,quantity,price_base,sum_total,store_id\n2024-01-01,a,2,3.0,6.0,1\n"
    )
    (folder / "2.csv").write_text(
        "date,item_id,price_base,quantity,sum_total,store_id\n2024-01-01,b,3.0,2,6.0,1\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(folder), schemas.SALES).collect()


def test_csv_types(spark, tmp_path):
    path = tmp_path / "sales.csv"
    head = "date,item_id,quantity,price_base,sum_total,store_id\n"
    path.write_text(head + "2024-01-01 00:00:00,a,2,3.0,6.0,1.0\n2024-01-02,b,,,,\n")
    found = tables.read_sales(spark, str(path))
    assert sorted(map(tuple, found.collect()))[0] == (day(0), "a", 2.0, 3.0, 6.0, 1)
    assert rows(found.where("store_id is null"), "date") == [(day(1),)]
    for bad in ("2024-01-01,a,2,3.0,6.0,1.5", "2024-01-01,a,2,3.0,6.0,x", "x,a,2,3.0,6.0,1"):
        path.write_text(head + bad + "\n")
        with pytest.raises(Exception, match="(?i)cast|pars"):
            tables.read_csv(spark, str(path), schemas.SALES).collect()


def test_csv_without_a_needed_column_raises(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("date,item_id\n2024-01-01,abc\n")
    with pytest.raises(Exception, match="quantity"):
        tables.read_csv(spark, str(path), schemas.SALES)


def test_csv_round_trip(spark, tmp_path):
    sales = frames.hot_sales(spark, 200)
    tables.write_csv(sales, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), schemas.SALES)
    assert sorted(map(str, back.collect())) == sorted(map(str, sales.collect()))


def test_static_tables(spark, tmp_path):
    root = str(tmp_path)
    catalog = frames.catalog(spark, "a").withColumn("Unnamed: 0", F.lit(0))
    markdowns = frames.markdowns(spark, [(0, "a", 1, 1.0, 2.0, 3.0), (5, "a", 1, 1.0, 2.0, 3.0)])
    tables.land_static({"catalog": catalog, "markdowns": markdowns}, root)
    assert tables.read_static(spark, root, "catalog").columns == schemas.CATALOG.names
    found = tables.read_static(spark, root, "markdowns")
    assert zones.between_dates(found, day(5), day(5)).count() == 1
    assert "make_date" in plan(zones.between_dates(found, day(5), day(5)))
    tables.land_static({}, root)


def test_workspace_follows_the_cluster_setting(spark):
    shared = spark.conf.get(SETTING)
    first, second = fresh_directory(spark, "x"), fresh_directory(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)


def test_workspace_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match=SETTING):
        fresh_directory(_Cluster, "x")


def test_a_single_file_can_be_inspected(spark, tmp_path):
    zones.write_by_date(one_day(spark, 0), str(tmp_path / "zone"))
    (file,) = glob.glob(f"{tmp_path}/zone/year=2024/month=1/day=1/*.parquet")
    df = spark.read.parquet(file)
    assert df.columns == schemas.SALES.names  # the date parts are in the path only
    assert len(df.limit(1).collect()) == 1


def test_open_bounds(spark):
    df = one_day(spark, 0).unionByName(one_day(spark, 5)).unionByName(one_day(spark, 9))
    assert zones.between_dates(df, last=day(5)).count() == 4
    assert zones.between_dates(df, day(5)).count() == 4
    assert zones.between_dates(df).count() == 6


def test_a_side_table_without_rows_reads_as_empty(spark, tmp_path):
    tables.land_static({"markdowns": frames.markdowns(spark)}, str(tmp_path))
    found = tables.read_static(spark, str(tmp_path), "markdowns")
    assert zones.between_dates(found, day(0), day(9)).isEmpty()
    assert found.columns == [*schemas.MARKDOWNS.names, "year", "month", "day"]


def test_feature_schema_is_what_is_written(spark, tmp_path):
    table = feature_table(
        one_day(spark, 0),
        frames.catalog(spark, "a"),
        frames.stores(spark, 1),
        frames.markdowns(spark),
        frames.discounts(spark),
    )
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in schemas.FEATURES
    ]
    path = str(tmp_path / "features")
    zones.write_by_date(table, path)
    given = zones.read_zone(spark, path, schemas.FEATURES).select(*schemas.FEATURE_COLUMNS)
    found = zones.read_zone(spark, path).select(*schemas.FEATURE_COLUMNS)
    assert rows(given) == rows(found) == rows(table)
