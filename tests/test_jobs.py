"""The jobs end to end on a small assortment, and the model."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import frames
from frames import day
from shelfcast.__main__ import parser, run
from shelfcast.operators import aggregates
from shelfcast.plans import jobs, training
from shelfcast.schemas import CATEGORY_INPUTS, FORECAST_COLUMNS, NUMERIC_INPUTS, TARGET
from shelfcast.sources import publish, zones

ITEMS, STORES, DAYS = ["a", "b"], [1, 2], 75


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Raw CSVs with a stray index column, an item to be left out, and no actual matrix."""
    folder = tmp_path_factory.mktemp("raw")
    sales, markdowns, discounts, prices = [], [], [], []
    for d in range(DAYS):
        for item in [*ITEMS, "left out"]:
            for store in STORES:
                units = 5 + (d % 7) * 3 + (item == "b") * 10 + store
                sales.append(f"{len(sales)},{day(d)},{item},{units},2.5,{units * 2.5},{store}")
                if d % 9 == store:
                    markdowns.append(f"{day(d)},{item},{store},2,1.5,2.5")
                if d % 8 == store:
                    discounts.append(f"{day(d)},{item},{store},3,2.0,2.5")
                prices.append(f"{day(d)},{item},{store},2.5")
    files = {
        "sales": ["Unnamed: 0,date,item_id,quantity,price_base,sum_total,store_id", *sales],
        "markdowns": ["date,item_id,store_id,quantity,price,normal_price", *markdowns],
        "discounts_history": [
            "date,item_id,store_id,promo_type_code,sale_price_time_promo,sale_price_before_promo",
            *discounts,
        ],
        "price_history": ["date,item_id,store_id,price", *prices],
        "catalog": [
            "item_id,dept_name,class_name,subclass_name,item_type",
            "a,food,fruit,apple,",
            "b,food,dairy,milk,fresh",
            "left out,x,x,x,x",
        ],
        "stores": ["store_id,division,format,city,area", "1,north,big,x,100", "2,south,small,y,50"],
    }
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def root(spark, raw, tmp_path_factory):
    """Landed, with features and a model, as the command line does it."""
    root = str(tmp_path_factory.mktemp("zones"))
    for command in (
        ["land-history", "--root", root, "--raw", raw, "--items", *ITEMS],
        ["features", "--root", root],
        ["train", "--root", root, "--model", f"{root}/model"],
    ):
        run(spark, parser().parse_args(command))
    return root


def test_history_is_landed_without_recent_dates(spark, root):
    history, recent = (zones.read_zone(spark, f"{root}/{n}") for n in ("sales", "recent"))
    assert zones.last_date(history).first()[0] == day(DAYS - 32)
    assert recent.select("date").distinct().count() == 31
    assert {r[0] for r in history.select("item_id").distinct().collect()} == set(ITEMS)


def test_history_is_landed_for_all_items_unless_some_are_named(spark, raw, tmp_path):
    root = str(tmp_path / "all")
    run(spark, parser().parse_args(["land-history", "--root", root, "--raw", raw]))
    landed = zones.read_zone(spark, f"{root}/sales")
    assert {r[0] for r in landed.select("item_id").distinct().collect()} == {*ITEMS, "left out"}
    assert {r[0] for r in spark.read.parquet(f"{root}/static/catalog").select("item_id").collect()} == {*ITEMS, "left out"}
    listed = tmp_path / "items.txt"
    listed.write_text("left out\n")
    args = ["land-history", "--root", root, "--raw", raw, "--items-file", str(listed)]
    run(spark, parser().parse_args(args))
    landed = zones.read_zone(spark, f"{root}/sales")
    assert {r[0] for r in landed.select("item_id").distinct().collect()} == {"left out"}
    manifest = zones.read_manifest(spark, jobs.manifest_path(root, "sales"))
    assert manifest.agg(F.sum("n_rows")).first()[0] == landed.count()


def test_daily_run_moves_one_day_and_can_be_repeated(spark, root):
    model = f"{root}/model"
    following = day(DAYS - 31)
    first_rows = jobs.run_daily(spark, root, model, table="forecasts_for_test").collect()
    assert zones.last_date(zones.read_zone(spark, f"{root}/features")).first()[0] == following
    n_features = zones.read_zone(spark, f"{root}/features").count()
    again = jobs.run_daily(spark, root, model, following, table="forecasts_for_test")
    assert zones.read_zone(spark, f"{root}/features").count() == n_features
    assert sorted(map(tuple, first_rows)) == sorted(map(tuple, again.collect()))
    assert again.columns == FORECAST_COLUMNS
    keys = again.select("date", "item_id", "store_id").distinct().count()
    assert keys == again.count() == len(ITEMS) * len(STORES) * 7
    assert again.agg(F.min("date"), F.max("date")).first()[:] == (
        day(DAYS - 30),
        day(DAYS - 24),
    )
    assert again.where("predicted_quantity < 0 or predicted_quantity is null").isEmpty()
    assert {r[0] for r in again.select("item_type").distinct().collect()} == {"unknown", "fresh"}
    published = spark.table("forecasts_for_test")
    assert sorted(map(tuple, published.collect())) == sorted(map(tuple, again.collect()))


def test_command_line_lands_and_builds_a_day(spark, root, capsys):
    later = str(day(DAYS - 20))
    run(spark, parser().parse_args(["land-day", "--root", root, "--ingestion-date", later]))
    run(spark, parser().parse_args(["features", "--root", root, "--process-date", later]))
    features = zones.read_zone(spark, f"{root}/features")
    assert zones.partition_row_count(features, later).first()[0] == len(ITEMS) * len(STORES)
    run(spark, parser().parse_args(["next-dates", "--root", root]))
    assert str(day(DAYS - 19)) in capsys.readouterr().out


def test_new_sales_come_from_a_file(spark, root, tmp_path):
    """Beyond the dates held back: the day after all raw data."""
    new = tmp_path / "new.csv"
    lines = [f"{day(DAYS)} 00:00:00,{item},7,2.5,17.5,{store}.0" for item in ITEMS for store in STORES]
    new.write_text("date,item_id,quantity,price_base,sum_total,store_id\n" + "\n".join(lines) + "\n")
    args = ["daily", "--root", root, "--model", f"{root}/model", "--arrivals", str(new)]
    run(spark, parser().parse_args([*args, "--process-date", str(day(DAYS))]))
    features = zones.read_zone(spark, f"{root}/features")
    assert zones.partition_row_count(features, day(DAYS)).first()[0] == len(ITEMS) * len(STORES)
    manifest = zones.read_manifest(spark, jobs.manifest_path(root, "features"))
    assert zones.last_date(manifest).first()[0] == day(DAYS)


def test_a_day_without_sales_stops(spark, root):
    with pytest.raises(jobs.NothingToForecast, match=str(day(DAYS + 6))):
        jobs.run_daily(spark, root, f"{root}/model", day(DAYS + 5))
    with pytest.raises(jobs.NothingToForecast, match="look-back"):
        jobs.forecast(spark, root, f"{root}/model", "1999-01-01")
    with pytest.raises(jobs.NothingToForecast, match="empty"):
        jobs.run_daily(spark, f"{root}/nowhere", f"{root}/model")


def test_an_empty_forecast_leaves_the_published_table(spark, root, caplog, monkeypatch):
    real = jobs.inference_features
    monkeypatch.setattr(jobs, "inference_features", lambda *a, **b: real(*a, **b).limit(0))
    old = spark.createDataFrame([(day(0), 1)], "date date, predicted_quantity int")
    publish.publish_table(old, "kept_forecasts")
    found = jobs.forecast(spark, root, f"{root}/model", day(DAYS - 31), table="kept_forecasts")
    assert found.isEmpty() and "nothing to forecast" in caplog.text
    assert [tuple(r) for r in spark.table("kept_forecasts").collect()] == [(day(0), 1)]


def test_past_from_features_or_sales_gives_the_same(spark, root, monkeypatch):
    later = str(day(DAYS - 31))
    jobs.build_features(spark, root, later)
    one = zones.between_dates(zones.read_zone(spark, f"{root}/features"), later, later).collect()
    assert jobs._past_is_whole(spark, root, day(DAYS - 31))
    monkeypatch.setattr(jobs, "_past_is_whole", lambda *_: False)
    jobs.build_features(spark, root, later)
    two = zones.between_dates(zones.read_zone(spark, f"{root}/features"), later, later).collect()
    assert len(one) == 4 and sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_jdbc_options_reach_the_writer(spark, root, monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "publish_jdbc", lambda df, url, **options: seen.update(options, url=url))
    monkeypatch.setenv("FORECAST_PASSWORD", "secret")
    args = ["forecast", "--root", root, "--model", f"{root}/model", "--forecast-date", str(day(DAYS - 31))]
    args += ["--jdbc-url", "jdbc:x", "--jdbc-table", "t", "--jdbc-user", "u", "--jdbc-driver", "d"]
    run(spark, parser().parse_args([*args, "--jdbc-password-env", "FORECAST_PASSWORD", "--plan", "raw"]))
    assert seen == {
        "url": "jdbc:x", "jdbc_table": "t", "user": "u", "password": "secret", "driver": "d", "batch": 10_000,
    }


def test_model_beats_the_training_mean_and_loads_the_same(spark, root):
    features = zones.read_zone(spark, f"{root}/features")
    end = day(DAYS - 32)
    model = training.load_model(f"{root}/model")
    predictions = training.validation_predictions(model, features, end)
    error = training.validation_rmse(predictions)
    mean = features.where(F.col("date") <= day(DAYS - 46)).agg(F.avg(TARGET)).first()[0]
    naive = aggregates.rmse(predictions.withColumn("mean", F.lit(mean)), TARGET, "mean").first()[0]
    assert math.isfinite(error) and error < naive
    assert error == pytest.approx(aggregates.rmse(predictions, TARGET, "prediction").first()[0])
    training.save_model(model, f"{root}/copy")
    training.save_model(model, f"{root}/copy")
    copy = training.validation_predictions(training.load_model(f"{root}/copy"), features, end)
    key = ["date", "item_id", "store_id", "prediction"]
    assert sorted(map(tuple, predictions.select(key).collect())) == sorted(
        map(tuple, copy.select(key).collect())
    )
    assert model.stages[-1].getNumTrees == 50


def test_a_model_without_items(spark, root):
    """Item labels are held by the driver; a model can do without them."""
    features = zones.read_zone(spark, f"{root}/features")
    columns = [c for c in CATEGORY_INPUTS if c != "item_id"]
    pipeline = training.demand_pipeline(trees=3, columns=columns, numeric=NUMERIC_INPUTS)
    model = training.train_model(features, day(DAYS - 32), pipeline=pipeline)
    predictions = training.validation_predictions(model, features, day(DAYS - 32))
    assert math.isfinite(training.validation_rmse(predictions))
    assert "item_id_indexed" not in predictions.columns


def test_training_without_rows(spark, root):
    features = zones.read_zone(spark, f"{root}/features")
    assert training.train_model(features, "1990-01-01") is None
    model = training.load_model(f"{root}/model")
    nothing = training.validation_predictions(model, features, "1990-01-01")
    assert training.validation_rmse(nothing) is None


def test_unseen_and_missing_categories_encode_to_zero(spark):
    seen = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "kind string")
    stages = [training.category_indexer(["kind"]), training.category_encoder(["kind"])]
    model = Pipeline(stages=stages).fit(seen)
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "kind string")
    encoded = {
        r["kind"]: list(r["v"])
        for r in model.transform(new)
        .select("kind", vector_to_array("kind_encoded").alias("v"))
        .collect()
    }
    assert encoded["b"] == [1, 0, 0] and encoded["a"] == [0, 1, 0] and encoded["c"] == [0, 0, 1]
    assert encoded["z"] == [0, 0, 0] and encoded[None] == [0, 0, 0]


def test_missing_side_files_are_passed_over(spark, raw, tmp_path, caplog):
    found = jobs._side_files(spark, raw)
    assert "actual_matrix" not in found and "catalog" in found
    assert "actual_matrix.csv" in caplog.text


def test_forecast_path():
    assert publish.forecast_path("r", "2024-08-05") == "r/year=2024/month=08/day=05"


def test_forecast_summary(spark):
    rows = [(day(0), 2), (day(0), 3)]
    forecast = spark.createDataFrame(rows, "date date, predicted_quantity int")
    assert tuple(publish.forecast_summary(forecast).first()) == (day(0), 2, 5)


def test_table_is_replaced_as_a_whole_even_from_another_path(spark, tmp_path):
    for n in (1, 2):
        forecast = spark.createDataFrame([(day(n), n)], "date date, predicted_quantity int")
        written = publish.publish_parquet(forecast, str(tmp_path / "forecasts"), day(n))
        publish.publish_table(spark.read.parquet(written), "replaced", str(tmp_path / f"t{n}"))
    assert [tuple(r) for r in spark.table("replaced").collect()] == [(day(2), 2)]
