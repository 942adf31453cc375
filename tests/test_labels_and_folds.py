"""Labels as a table against the indexer, and errors by fold against a loop."""

import random

import pytest
from pyspark.sql import functions as F

import frames
from frames import day
from shelfcast.plans import training
from shelfcast.plans.backtest import backtest, rolling_ends
from shelfcast.plans.features import feature_table
from shelfcast.plans.labels import index_by_table, indexed_pipeline, label_table, train_with_labels
from shelfcast.schemas import KEYS, TARGET

COLUMNS = ["item_id", "dept_name", "division"]
SIMPLE = dict(trees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=3)


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    rng = random.Random(2)
    items = [f"i{n}" for n in range(7)]
    rows = [(n, rng.choice(items), rng.choice((1, 2)), float(rng.randrange(9)), 2.0) for n in range(60) for _ in range(4)]
    table = feature_table(
        frames.sales(spark, rows), frames.catalog(spark, *items[:5]), frames.stores(spark, 1),
        frames.markdowns(spark), frames.discounts(spark),
    )
    return frames.stored(spark, table, tmp_path_factory.mktemp("features"))


@pytest.fixture
def store_rows(spark, tmp_path):
    def store(df, name):
        return frames.stored(spark, df, tmp_path)

    return store


def test_positions_are_those_of_the_indexer(spark, features, store_rows):
    rows = features.select(*COLUMNS)
    labels = label_table(rows, COLUMNS, store_rows)
    model = training.category_indexer(COLUMNS).fit(rows)
    want = {(c, v): float(i) for c, values in zip(COLUMNS, model.labelsArray) for i, v in enumerate(values)}
    assert {(r[0], r[1]): r[2] for r in labels.collect()} == want
    new = rows.unionByName(spark.createDataFrame([("new", None, "x")], rows.schema))
    by_table = index_by_table(new, labels, COLUMNS).collect()
    by_model = model.transform(new).collect()
    assert sorted(map(str, by_table)) == sorted(map(str, by_model))
    assert label_table(rows.limit(0), COLUMNS, store_rows).isEmpty()


def test_a_model_trained_on_the_table_predicts_the_same(features, store_rows):
    model, labels = train_with_labels(
        features, day(59), store_rows, columns=COLUMNS, pipeline=indexed_pipeline(COLUMNS, **SIMPLE)
    )
    plain = training.train_model(features, day(59), pipeline=training.demand_pipeline(columns=COLUMNS, **SIMPLE))
    got = model.transform(index_by_table(features, labels, COLUMNS)).select(*KEYS, "prediction")
    want = plain.transform(features).select(*KEYS, "prediction")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len({r["prediction"] for r in want.collect()}) > 1
    assert train_with_labels(features, "1990-01-01", store_rows) is None


def test_errors_by_fold_and_day(features):
    ends = rolling_ends(day(59), 3, step=10)
    assert ends == [day(39), day(49), day(59)]
    mean = training.demand_pipeline(trees=1, bootstrap=False, maxDepth=0)
    got = {(r["fold"], r["ahead"]): r for r in backtest(features, [*ends, "1990-01-01"], 5, mean).collect()}
    rows = features.select("date", TARGET).collect()
    for fold, end in enumerate(ends):
        seen = [r for r in rows if (r["date"] - end).days <= -5]
        predicted = sum(r[TARGET] for r in seen) / len(seen)
        for ahead in (1, 2, 3, 4, 5, None):
            days = [r[TARGET] for r in rows if 0 < (r["date"] - end).days + 5 <= 5 and ahead in (None, (r["date"] - end).days + 5)]
            row = got.pop((fold, ahead))
            assert row["n_rows"] == len(days)
            assert row["mean_error"] == pytest.approx(sum(predicted - y for y in days) / len(days))
            assert row["rmse"] == pytest.approx((sum((predicted - y) ** 2 for y in days) / len(days)) ** 0.5)
    assert not got
    assert backtest(features, ["1990-01-01"], 5, mean).where(F.col("n_rows") > 0).isEmpty()
