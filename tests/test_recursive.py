"""Forecasts fed back, against a loop over days."""

import datetime as dt
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

import frames
from frames import day
from shelfcast.plans import jobs
from shelfcast.plans.features import feature_table
from shelfcast.plans.frame import inference_features
from shelfcast.plans.recursive import recursive_forecast

START, DAYS = 40, 10


@pytest.fixture(scope="module")
def model(spark):
    """A formula in place of a forest: it reads the lag and both means."""
    formula = "0.5 * lag_7_quantity + rolling_mean_7_quantity - 0.25 * rolling_mean_30_quantity + day_of_week"
    stage = SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__")
    return Pipeline(stages=[stage]).fit(spark.range(1))


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(n, i, s, float((n * 7 + s) % 11), 2.0) for n in range(START) for i in "ab" for s in (1, 2) if n % (s + 2)]
    sides = frames.catalog(spark, "a", "b", "new"), frames.stores(spark, 1, 2)
    markdowns = frames.markdowns(spark, [(41, "a", 1, 2.0, 1.0, 2.0)])
    discounts = frames.discounts(spark, [(42, "b", 2, 3.0, 1.0, 2.0)])
    history = feature_table(frames.sales(spark, rows), *sides, markdowns, discounts)
    return rows, (history, *sides, markdowns, discounts, frames.prices(spark, [(43, "a", 2, 4.0)]))


def stored(spark, folder):
    def store_rows(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return store_rows


def mean(values):
    return sum(values) / len(values) if values else 0.0


def test_matches_a_loop(spark, tables, model, tmp_path):
    rows, inputs = tables
    found = recursive_forecast(model, *inputs, day(START), stored(spark, tmp_path), DAYS)
    got = {(r["item_id"], r["store_id"], r["date"]): r for r in found.collect()}
    assert len(got) == found.count() == 3 * 2 * DAYS
    for item in ("a", "b", "new"):
        for store in (1, 2):
            values = [q for n, i, s, q, _ in rows if (i, s) == (item, store)]
            for n in range(START, START + DAYS):
                row = got[item, store, day(n)]
                lag = values[-7] if len(values) >= 7 else 0.0
                weekday = (day(n).weekday() + 1) % 7 + 1
                prediction = 0.5 * lag + mean(values[-6:]) - 0.25 * mean(values[-29:]) + weekday
                assert row["lag_7_quantity"] == lag
                assert row["rolling_mean_7_quantity"] == pytest.approx(mean(values[-6:]))
                assert row["rolling_mean_30_quantity"] == pytest.approx(mean(values[-29:]))
                assert abs(row["predicted_quantity"] - max(math.trunc(prediction), 0)) <= 0
                values.append(float(row["predicted_quantity"]))
    assert got["a", 1, day(41)]["markdown_quantity"] == 2.0 and got["b", 2, day(42)]["on_promotion"] == 1
    assert got["a", 2, day(43)]["avg_base_price"] == 4.0


def test_the_first_day_is_that_of_the_plain_plan(spark, tables, model, tmp_path):
    _, inputs = tables
    found = recursive_forecast(model, *inputs, day(START), stored(spark, tmp_path), 1)
    plain = inference_features(*inputs, day(START), 1)
    columns = [c for c in plain.columns if c != "total_quantity"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


def test_a_day_reads_past_values_no_more(spark, tables, model, tmp_path):
    """The plan of the last day has the written inputs and short lists, not the history."""
    _, inputs = tables
    found = recursive_forecast(model, *inputs, day(START), stored(spark, tmp_path), 3)
    plan = found._jdf.queryExecution().toString()
    assert "newest_first" not in plan and plan.count("day-") >= 3


def test_raw_plans_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="aggregate"):
        jobs.forecast(spark, str(tmp_path), "", dt.date(2024, 1, 1), plan="raw", feed_back=True)
