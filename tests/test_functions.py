import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import DAY, day, expected_series
from shelfcast import schemas
from shelfcast.functions import cleaning
from shelfcast.functions.calendar import (
    as_date,
    calendar_columns,
    parse_date,
    partition_path,
    shift,
)
from shelfcast.functions.scalars import promotion_flag, whole_units
from shelfcast.functions.series import series_columns
from shelfcast.operators.profile import dummies


def test_date_arguments():
    assert as_date("2024-02-29") == dt.date(2024, 2, 29)
    assert as_date(DAY) is DAY
    assert shift("2024-03-01", -1) == dt.date(2024, 2, 29)
    with pytest.raises(ValueError):
        as_date("2024-02-30")


def test_calendar_uses_iso_weeks_and_sunday_first(spark):
    dates = [dt.date(2024, 12, 30), dt.date(2024, 12, 29), dt.date(2021, 1, 2)]
    df = spark.createDataFrame([(d,) for d in dates], "date date").withColumns(calendar_columns())
    rows = {r["date"]: r for r in df.collect()}
    monday, sunday, saturday = (rows[d] for d in dates)
    assert (monday["week_of_year"], monday["year"], monday["day_of_week"]) == (1, 2024, 2)
    assert (sunday["day_of_week"], sunday["is_weekend"]) == (1, 1)
    assert (saturday["day_of_week"], saturday["is_weekend"], saturday["week_of_year"]) == (7, 1, 53)
    assert monday["is_weekend"] == 0


def test_dates_are_read_with_a_time_or_without(spark):
    text = ["2024-08-01", "2024-08-01 00:00:00", "2024-08-01T12:30:00Z", None]
    df = spark.createDataFrame([(t,) for t in text], "t string").select(parse_date(F.col("t")))
    assert [r[0] for r in df.collect()] == [dt.date(2024, 8, 1)] * 3 + [None]
    for bad in ("2024-08-01x", "yesterday", "2024-02-30"):
        with pytest.raises(Exception, match="(?i)pars|cast|date"):
            spark.createDataFrame([(bad,)], "t string").select(parse_date(F.col("t"))).collect()


def test_partition_paths(spark):
    df = spark.createDataFrame([(dt.date(2024, 8, 5),)], "date date")
    row = df.select(partition_path().alias("a"), partition_path(padded=False).alias("b")).first()
    assert row["a"] == "year=2024/month=08/day=05"
    assert row["b"] == "year=2024/month=8/day=5"


@pytest.mark.parametrize(
    "code, quantity, flag",
    [(None, None, 0), (None, 0.0, 0), (None, 2.0, 1), (3.0, None, 1), (3.0, 0.0, 1)],
)
def test_promotion_flag_is_never_null(spark, code, quantity, flag):
    df = spark.createDataFrame(
        [(code, quantity)], "promo_type_code double, markdown_quantity double"
    )
    assert df.select(promotion_flag()).first()[0] == flag


@pytest.mark.parametrize(
    "prediction, units", [(2.9, 2), (-0.5, 0), (-3.7, 0), (0.0, 0), (7.0, 7), (None, None)]
)
def test_whole_units(spark, prediction, units):
    df = spark.createDataFrame([(prediction,)], "p double")
    assert df.select(whole_units(F.col("p"))).first()[0] == units


def test_fills_pass_over_other_types(spark):
    df = spark.createDataFrame([(None, None, None)], "a double, b string, promo_type_code double")
    row = cleaning.fill_numeric(df, ["a", "b"]).first()
    assert row["a"] == 0 and row["b"] is None
    row = cleaning.fill_categories(df, ["b", "promo_type_code", "not there"]).first()
    assert row["b"] == "unknown" and row["promo_type_code"] is None
    with pytest.raises(Exception, match="not there"):
        cleaning.fill_numeric(df, ["not there"]).collect()


def test_stray_index_and_missing_target(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "`Unnamed: 0` int, total_quantity double")
    assert cleaning.drop_stray_index(df).columns == ["total_quantity"]
    assert cleaning.drop_stray_index(cleaning.drop_stray_index(df)).columns == ["total_quantity"]
    assert cleaning.drop_missing_target(df).count() == 1


def test_dummies(spark):
    rows = [("a", "b", 1), ("b", "a", 2), ("a", "c", 3)]
    df = spark.createDataFrame(rows, "A string, B string, C int")
    encoded = dummies(df, "A", {"b", "a"})
    assert encoded.columns == ["B", "C", "A_a", "A_b"]
    assert [tuple(r) for r in encoded.orderBy("C").collect()] == [
        ("b", 1, 1, 0),
        ("a", 2, 0, 1),
        ("c", 3, 1, 0),
    ]


def _series_frame(spark, series):
    rows = [
        (day(d), item, 1, q)
        for item, points in series.items()
        for d, q in points
    ]
    return spark.createDataFrame(
        rows, "date date, item_id string, store_id int, total_quantity double"
    )


def test_lags_count_rows_not_days(spark):
    days = [0, 1, 2, 4, 5, 7, 8, 9, 10, 11]
    history = [(d, float(n)) for n, d in enumerate(days)]
    future = [(d, None) for d in range(12, 19)]
    df = _series_frame(spark, {"x": history + future}).withColumns(series_columns())
    rows = df.orderBy("date").collect()
    want = expected_series([q for _, q in history + future])
    for row, expected in zip(rows, want, strict=True):
        for name, value in expected.items():
            assert row[name] == value, (row["date"], name)
    assert rows[7]["lag_7_quantity"] == 0.0 and (rows[7]["date"] - rows[0]["date"]).days == 9
    assert rows[-1]["rolling_mean_7_quantity"] is None
    assert rows[-2]["rolling_mean_7_quantity"] == 9.0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.sampled_from(["x", "y", "z"]),
        st.dictionaries(
            st.integers(0, 500), st.one_of(st.none(), st.integers(0, 50).map(float)), max_size=120
        ),
        min_size=1,
    )
)
def test_windows_match_brute_force(spark, series):
    ordered = {k: sorted(v.items()) for k, v in series.items()}
    df = _series_frame(spark, ordered).withColumns(series_columns())
    got = {(r["item_id"], r["date"]): r for r in df.collect()}
    for item, points in ordered.items():
        for (d, _), expected in zip(points, expected_series([q for _, q in points]), strict=True):
            row = got[item, day(d)]
            assert {n: row[n] for n in expected} == expected


def test_feature_columns():
    assert len(schemas.FEATURE_COLUMNS) == 31 == len(set(schemas.FEATURE_COLUMNS))
    assert len(schemas.NUMERIC_INPUTS) == 20 and len(schemas.CATEGORY_INPUTS) == 9
    assert len(schemas.FORECAST_COLUMNS) == 12
