"""Column names and types shared by every job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_DATE, _TEXT, _INT, _NUM = DateType(), StringType(), IntegerType(), DoubleType()

SALES = _schema(
    date=_DATE, item_id=_TEXT, quantity=_NUM, price_base=_NUM, sum_total=_NUM, store_id=_INT
)
CATALOG = _schema(
    item_id=_TEXT, dept_name=_TEXT, class_name=_TEXT, subclass_name=_TEXT, item_type=_TEXT
)
STORES = _schema(store_id=_INT, division=_TEXT, format=_TEXT, city=_TEXT, area=_TEXT)
MARKDOWNS = _schema(
    date=_DATE, item_id=_TEXT, store_id=_INT, quantity=_NUM, price=_NUM, normal_price=_NUM
)
DISCOUNTS = _schema(
    date=_DATE,
    item_id=_TEXT,
    store_id=_INT,
    promo_type_code=_NUM,
    sale_price_time_promo=_NUM,
    sale_price_before_promo=_NUM,
)
PRICES = _schema(date=_DATE, item_id=_TEXT, store_id=_INT, price=_NUM)
ACTUAL_MATRIX = _schema(date=_DATE, item_id=_TEXT)

# The side tables that accompany the sales, by file name.
STATIC_TABLES = {
    "markdowns": MARKDOWNS,
    "price_history": PRICES,
    "discounts_history": DISCOUNTS,
    "actual_matrix": ACTUAL_MATRIX,
    "catalog": CATALOG,
    "stores": STORES,
}

DIMENSION_KEYS = {"catalog": "item_id", "stores": "store_id"}

KEYS = ["date", "item_id", "store_id"]
SERIES = ["item_id", "store_id"]
DATE_PARTS = ["year", "month", "day"]
TARGET = "total_quantity"

ITEM_ATTRIBUTES = ["dept_name", "class_name", "subclass_name", "item_type"]
STORE_ATTRIBUTES = ["division", "format", "city", "area"]
ATTRIBUTES = ITEM_ATTRIBUTES + STORE_ATTRIBUTES

PRICE_COLUMNS = [
    "avg_base_price",
    "markdown_quantity",
    "markdown_price",
    "markdown_normal_price",
    "promo_price",
    "discount_price_before_promo",
]
CALENDAR_COLUMNS = ["day_of_week", "month", "year", "week_of_year", "is_weekend", "day"]

# Lag distances and mean widths, counted in rows of a series.
LAGS = (7, 30, 90, 365)
MEANS = (7, 30)
SERIES_COLUMNS = [f"lag_{n}_quantity" for n in LAGS] + [
    f"rolling_mean_{n}_quantity" for n in MEANS
]

FEATURE_COLUMNS = (
    KEYS
    + [TARGET]
    + PRICE_COLUMNS
    + ["on_promotion"]
    + CALENDAR_COLUMNS
    + SERIES_COLUMNS
    + ATTRIBUTES
)
_FEATURE_TYPES = {
    "date": _DATE,
    "store_id": _INT,
    "on_promotion": _INT,
    **dict.fromkeys(["item_id", *ATTRIBUTES], _TEXT),
    **dict.fromkeys(CALENDAR_COLUMNS, _INT),
}
FEATURES = _schema(**{c: _FEATURE_TYPES.get(c, _NUM) for c in FEATURE_COLUMNS})
NUMERIC_INPUTS = (
    ["store_id"] + PRICE_COLUMNS + ["on_promotion"] + CALENDAR_COLUMNS + SERIES_COLUMNS
)
CATEGORY_INPUTS = ["item_id"] + ATTRIBUTES
FORECAST_COLUMNS = KEYS + ATTRIBUTES + ["predicted_quantity"]

LOOKBACK_DAYS = 365
RECENT_DAYS = 30
HOLDOUT_DAYS = 14
HORIZON_DAYS = 7
UNKNOWN = "unknown"

# A first assortment to try the jobs with. No job falls back on it.
SELECTED_ITEMS = [
    "e5b2b6f57ea7",
    "2c007023f650",
    "23b18d1f7da9",
    "0973df3ff57f",
    "99d388c37359",
    "d9f5cbd8e676",
    "f1eb9c33424e",
    "b4f43c361b93",
    "6d284b4e9982",
    "58447f11c3b0",
]


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _typed(column: Column, found: DataType, wanted: DataType) -> Column:
    """A column cast to a type. Whole numbers written with a decimal point, as text columns
    with gaps often have them, are whole numbers; any other text raises."""
    if isinstance(found, StringType) and isinstance(wanted, IntegerType):
        number = column.cast("double")
        return F.when(number == F.floor(number), number.cast(wanted)).otherwise(column.cast(wanted))
    return column.cast(wanted)


def conform(df: DataFrame, schema: StructType, keep_rest: bool = False) -> DataFrame:
    """Pick the columns of ``schema`` by name and cast them to its types. Other columns (a
    stray index, say) go unless ``keep_rest``. A column the frame lacks raises."""
    found = {f.name: f.dataType for f in df.schema}
    named = [_typed(F.col(f.name), found.get(f.name), f.dataType).alias(f.name) for f in schema]
    rest = [c for c in df.columns if c not in schema.names] if keep_rest else []
    return df.select(*named, *[F.col(f"`{c}`") for c in rest])
