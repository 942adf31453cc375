"""DuckDB SQL equivalents of ``checks.queries``, by the same names."""

from __future__ import annotations

from checks.oracle_views import ATTRIBUTES_FILLED, CALENDAR, finished, with_views

_D = "CAST(date AS VARCHAR) AS date"
_KEYS = f"{_D}, item_id, store_id"
_PRICES = [
    "avg_base_price",
    "markdown_quantity",
    "markdown_price",
    "markdown_normal_price",
    "promo_price",
    "discount_price_before_promo",
]
_SERIES = [
    "lag_7_quantity",
    "lag_30_quantity",
    "lag_90_quantity",
    "lag_365_quantity",
    "rolling_mean_7_quantity",
    "rolling_mean_30_quantity",
]
_CALENDAR = ["day_of_week", "month", "year", "week_of_year", "is_weekend", "day"]
_ATTRIBUTES = [
    "dept_name",
    "class_name",
    "subclass_name",
    "item_type",
    "division",
    "format",
    "city",
    "area",
]
_ITEMS = "(" + ", ".join(f"'Brand#{n}'" for n in range(1, 11)) + ")"


def _step(*columns: str) -> str:
    """Mean prices to six decimals, as the queries give them; units as they are."""
    return ", ".join(
        c if c == "markdown_quantity" else f"floor({c} * 1e6 + 0.123457) / 1e6 AS {c}"
        for c in columns
    )


def _list(*columns: str) -> str:
    return ", ".join(columns)


_FEATURES = _list(
    _KEYS,
    "total_quantity",
    _step(*_PRICES),
    "on_promotion",
    *_CALENDAR,
    *_SERIES,
    *_ATTRIBUTES,
)

_KEPT = f"kept AS (SELECT * FROM sales WHERE item_id IN {_ITEMS})"
_PARTS = """parts AS (
  SELECT *, CASE WHEN date < (SELECT max(date) - 30 FROM kept) THEN 'history' ELSE 'recent' END
    AS part
  FROM kept)"""

_ALL_PARTS = _PARTS.replace("kept", "sales")


def _landed(parts: str) -> str:
    return f"""SELECT {_D}, count(*) AS n_rows, sum(quantity) AS units,
        CASE WHEN part = 'history' THEN 'sales' ELSE part END AS part,
        CASE WHEN part = 'history' THEN count(*) END AS n_recorded
        FROM {parts} GROUP BY date, part"""


_DAY = "DATE '2001-07-01'"
_LOOKBACK = f"""
window_daily AS (
  SELECT date, item_id, store_id, sum(coalesce(quantity, 0)) AS total_quantity,
         avg(coalesce(price_base, 0)) AS avg_base_price
  FROM sales WHERE date BETWEEN {_DAY} - 365 AND {_DAY} GROUP BY ALL),
window_series AS (
  SELECT *,
         lag(total_quantity, 7) OVER w AS lag_7_quantity,
         lag(total_quantity, 30) OVER w AS lag_30_quantity,
         lag(total_quantity, 90) OVER w AS lag_90_quantity,
         lag(total_quantity, 365) OVER w AS lag_365_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS rolling_mean_7_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS rolling_mean_30_quantity
  FROM window_daily WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date)),
day_rows AS (SELECT * FROM window_series WHERE date = {_DAY})"""

_GRID = f"""
grid AS (
  SELECT item_id, store_id, CAST({_DAY} + CAST(i AS INTEGER) AS DATE) AS date
  FROM (SELECT DISTINCT item_id FROM catalog), (SELECT DISTINCT store_id FROM stores),
       range(7) AS days(i))"""

_FRAME = f"""{_GRID},
frame AS (
  SELECT grid.*, avg_base_price, markdown_quantity, markdown_price, markdown_normal_price,
         promo_type_code, promo_price, discount_price_before_promo,
         dept_name, class_name, subclass_name, item_type, division, format, city, area
  FROM grid
  LEFT JOIN daily_markdowns USING (date, item_id, store_id)
  LEFT JOIN daily_discounts USING (date, item_id, store_id)
  LEFT JOIN daily_prices USING (date, item_id, store_id)
  LEFT JOIN catalog USING (item_id) LEFT JOIN stores USING (store_id))"""

_INFERENCE = f"""{_GRID},
combined AS (
  SELECT date, item_id, store_id, total_quantity FROM daily
  WHERE date BETWEEN {_DAY} - 366 AND {_DAY} - 1
  UNION ALL SELECT date, item_id, store_id, NULL FROM grid),
combined_series AS (
  SELECT *,
         lag(total_quantity, 7) OVER w AS lag_7_quantity,
         lag(total_quantity, 30) OVER w AS lag_30_quantity,
         lag(total_quantity, 90) OVER w AS lag_90_quantity,
         lag(total_quantity, 365) OVER w AS lag_365_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS rolling_mean_7_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS rolling_mean_30_quantity
  FROM combined WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date)),
horizon AS (
  SELECT combined_series.*, avg_base_price FROM combined_series
  LEFT JOIN daily_prices USING (date, item_id, store_id)
  WHERE date BETWEEN {_DAY} AND {_DAY} + 6),
inference AS ({finished("horizon")})"""

_INFERRED = (
    "SELECT "
    + _list(_KEYS, _step(*_PRICES), "on_promotion", *_CALENDAR, *_SERIES, *_ATTRIBUTES)
    + " FROM inference"
)


# The forest of one leaf forecasts the same units for every row; each day sees those before it.
_RECURSIVE = f"""{_GRID.replace("range(7)", "range(9)")},
combined AS (
  SELECT date, item_id, store_id, total_quantity FROM daily
  WHERE date BETWEEN {_DAY} - 366 AND {_DAY} - 1
  UNION ALL SELECT date, item_id, store_id, greatest(trunc(prediction), 0) FROM grid, mean),
combined_series AS (
  SELECT *,
         lag(total_quantity, 7) OVER w AS lag_7_quantity,
         lag(total_quantity, 30) OVER w AS lag_30_quantity,
         lag(total_quantity, 90) OVER w AS lag_90_quantity,
         lag(total_quantity, 365) OVER w AS lag_365_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
           AS rolling_mean_7_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 29 PRECEDING AND 1 PRECEDING)
           AS rolling_mean_30_quantity
  FROM combined WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date)),
horizon AS (
  SELECT combined_series.*, avg_base_price FROM combined_series
  LEFT JOIN daily_prices USING (date, item_id, store_id)
  WHERE date BETWEEN {_DAY} AND {_DAY} + 8),
inferred AS ({finished("horizon")}),
inference AS (
  SELECT inferred.*, CAST(greatest(trunc(prediction), 0) AS INTEGER) AS predicted_quantity
  FROM inferred, mean)"""


def _raw_inference() -> str:
    """With the planned rows as they are, in place of one for each date, item and store."""
    planned = """
raw_markdowns AS (
  SELECT date, item_id, store_id, quantity AS markdown_quantity, price AS markdown_price,
         normal_price AS markdown_normal_price FROM markdowns),
raw_discounts AS (
  SELECT date, item_id, store_id, promo_type_code, sale_price_time_promo AS promo_price,
         sale_price_before_promo AS discount_price_before_promo FROM discounts),
raw_prices AS (SELECT date, item_id, store_id, price AS avg_base_price FROM prices)"""
    rows = _INFERENCE
    for name in ("markdowns", "discounts", "prices"):
        rows = rows.replace(f"daily_{name}", f"raw_{name}")
    return f"{planned},{rows}"


_PR_COUNTS = """
per_item AS (
  SELECT item_id, count(DISTINCT store_id) AS n_stores, count(DISTINCT date) AS active_days,
         count(*) AS n_rows, avg(quantity) AS mean_quantity
  FROM sales GROUP BY item_id),
everywhere AS (
  SELECT * FROM per_item WHERE n_stores = (SELECT count(DISTINCT store_id) FROM sales)),
top AS (SELECT * FROM everywhere ORDER BY n_rows DESC, item_id LIMIT 10)"""

_CATEGORIES = ["item_id", *_ATTRIBUTES]
_VALUES = (
    "category_counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows FROM features GROUP BY {c}"
        for c in _CATEGORIES
    )
    + """),
positions AS (
  SELECT column_name, value, n_rows,
         row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value) - 1 AS position
  FROM category_counts)"""
)

_STATIC_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys "
    f"FROM {view}{where}"
    for name, view, key, where in (
        ("markdowns", "markdowns", "item_id", f" WHERE item_id IN {_ITEMS}"),
        ("discounts_history", "discounts", "item_id", f" WHERE item_id IN {_ITEMS}"),
        ("price_history", "prices", "item_id", f" WHERE item_id IN {_ITEMS}"),
        ("catalog", "catalog", "item_id", f" WHERE item_id IN {_ITEMS}"),
        ("stores", "stores", "store_id", ""),
    )
)

_CSV_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, "
    f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {view})) AS n_distinct, "
    f"{f'round(sum({total}), 2)' if total else '0.0::DOUBLE'} AS total FROM {view}"
    for name, view, key, total in (
        ("markdowns", "markdowns", "item_id", "normal_price"),
        ("discounts_history", "discounts", "item_id", "promo_type_code"),
        ("price_history", "prices", "item_id", "price"),
        ("catalog", "catalog", "item_id", None),
        ("stores", "stores", "store_id", None),
        ("actual_matrix", "sold", "item_id", None),
    )
)

_MEAN = """
mean AS (SELECT avg(total_quantity) AS prediction FROM daily WHERE date <= DATE '2001-06-16'),
held_out AS (
  SELECT * FROM daily, mean WHERE date BETWEEN DATE '2001-06-17' AND DATE '2001-06-30')"""
_SCORED = f"""{_MEAN},
scored AS (
  SELECT frame.*, CAST(greatest(trunc(prediction), 0) AS INTEGER) AS predicted_quantity
  FROM frame, mean)"""

_NUMERIC = ["store_id", *_PRICES, "on_promotion", *_CALENDAR, *_SERIES]

ORACLES = {
    "feature_table": with_views("TR", f"SELECT {_FEATURES} FROM features"),
    "feature_table_fine_grain": with_views("BN", f"SELECT {_FEATURES} FROM features"),
    **{
        name: with_views(
            grain,
            f"SELECT {_FEATURES} FROM day_features",
            _LOOKBACK,
            f"day_features AS ({finished('day_rows')})",
        )
        for name, grain in (
            ("feature_table_incremental", "TR"),
            ("feature_table_incremental_daily", "DY"),
            ("feature_table_incremental_from_sales", "TR"),
        )
    },
    "feature_table_corrected": with_views("TR", f"SELECT {_FEATURES} FROM features"),
    "empty_feature_table": with_views(
        "TR", f"SELECT {_FEATURES} FROM features WHERE date <= DATE '1990-01-01'"
    ),
    "scan_csv_stray_index": with_views(
        "TR", f"SELECT {_KEYS}, quantity, price_base, sum_total FROM sales"
    ),
    "scan_csv_rejects": with_views(
        "TR",
        """SELECT 'accepted' AS kind, CAST(store_id AS VARCHAR) AS text, NULL AS reason,
        count(*) AS n_rows, sum(quantity) AS units FROM marked WHERE n_bad = 0 GROUP BY store_id
        UNION ALL SELECT 'quantity', 'many', 'not a number', count(*), NULL FROM marked WHERE q
        UNION ALL SELECT 'date', '2001-13-45', 'not a date', count(*), NULL FROM marked WHERE d
        UNION ALL SELECT 'store_id', '1.5', 'not a whole number', count(*), NULL FROM marked WHERE s
        UNION ALL SELECT 'rejected', NULL, NULL, count(*), NULL FROM marked WHERE n_bad > 0""",
        """flagged AS (
          SELECT *, CAST(floor(sum_total) AS BIGINT) % 50 = 3 AS q,
                 CAST(floor(sum_total) AS BIGINT) % 70 = 3 AS d,
                 CAST(floor(sum_total) AS BIGINT) % 90 = 3 AS s FROM sales),
        marked AS (SELECT *, q::INT + d::INT + s::INT AS n_bad FROM flagged)""",
    ),
    "scan_csv_tables": with_views(
        "BN", _CSV_COUNTS, "sold AS (SELECT date, item_id FROM sales)"
    ),
    "scan_one_date": with_views(
        "TR", f"SELECT {_KEYS}, quantity, price_base, sum_total FROM sales WHERE date = {_DAY}"
    ),
    "first_rows": with_views(
        "BN",
        f"""SELECT {_KEYS}, sum_total FROM (
          SELECT * FROM sales
          ORDER BY date, item_id, store_id, sum_total, quantity NULLS FIRST LIMIT 20)""",
    ),
    "scan_csv": with_views(
        "TR", f"SELECT {_KEYS}, quantity, price_base, sum_total FROM sales"
    ),
    "scan_partitioned": with_views(
        "TR",
        f"""SELECT {_KEYS}, quantity, price_base, sum_total, CAST(year(date) AS INTEGER) AS year,
        CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day FROM sales""",
    ),
    "scan_date_window": with_views(
        "TR",
        f"""SELECT {_KEYS}, quantity, sum_total FROM sales
        WHERE date BETWEEN {_DAY} - 365 AND {_DAY}""",
    ),
    "partition_row_count": with_views(
        "TR", f"SELECT count(*) AS n_rows FROM sales WHERE date = {_DAY}"
    ),
    "training_end_date": with_views(
        "TR", "SELECT CAST(max(date) AS VARCHAR) AS last_date FROM sales"
    ),
    "next_dates": with_views(
        "TR",
        """SELECT CAST(max(date) + 1 AS VARCHAR) AS process_date,
        CAST(max(date) + 2 AS VARCHAR) AS forecast_start FROM sales""",
    ),
    "write_features_roundtrip": with_views("TR", f"SELECT {_FEATURES} FROM features"),
    "ingest_history": with_views("BN", _landed("parts"), _ALL_PARTS),
    "ingest_history_of_items": with_views("BN", _landed("parts"), _KEPT, _PARTS),
    "ingest_day": with_views(
        "TR",
        f"""SELECT {_D}, count(*) AS n_rows, sum(quantity) AS units
        FROM sales WHERE date <= {_DAY} GROUP BY date""",
    ),
    "ingest_stream": with_views(
        "BN",
        f"SELECT {_D}, count(*) AS n_rows, sum(quantity) AS units FROM sales GROUP BY date",
    ),
    "ingest_static": with_views("BN", _STATIC_COUNTS),
    "select_items_static": with_views("BN", _STATIC_COUNTS),
    "partition_manifest": with_views(
        "BN",
        f"""SELECT {_D}, strftime(date, 'year=%Y/month=%m/day=%d') AS path,
        count(*) AS n_rows FROM sales GROUP BY date""",
    ),
    "history_split": with_views(
        "BN",
        f"""SELECT part, {_D}, item_id, count(*) AS n_rows,
        round(sum(sum_total), 2) AS sum_total
        FROM parts GROUP BY part, date, item_id""",
        _KEPT,
        _PARTS,
    ),
    "history_split_counts": with_views(
        "BN",
        """SELECT count(*) FILTER (part = 'history') AS n_history,
        count(*) FILTER (part = 'recent') AS n_recent, count(*) AS n_all FROM parts""",
        _KEPT,
        _PARTS,
    ),
    "train_validation_split": with_views(
        "TR",
        """SELECT CASE WHEN date <= DATE '2001-06-16' THEN 'train' ELSE 'validate' END AS part,
        count(*) AS n_rows, sum(total_quantity) AS units,
        CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date
        FROM daily WHERE date <= DATE '2001-06-30' GROUP BY 1""",
    ),
    "select_items": with_views("BN", f"SELECT {_KEYS}, sum_total FROM kept", _KEPT),
    "select_items_semi": with_views(
        "PR",
        f"SELECT {_KEYS}, sum_total FROM sales WHERE item_id IN (SELECT item_id FROM top)",
        _PR_COUNTS,
    ),
    "drop_null_target": with_views(
        "BN", f"SELECT {_KEYS}, quantity FROM sales WHERE quantity IS NOT NULL"
    ),
    "fill_numeric": with_views(
        "BN",
        f"""SELECT {_KEYS}, coalesce(quantity, 0) AS quantity,
        coalesce(price_base, 0) AS price_base, coalesce(sum_total, 0) AS sum_total FROM sales""",
    ),
    "fill_categorical": with_views(
        "BN",
        f"""SELECT {_KEYS}, {ATTRIBUTES_FILLED}, promo_type_code FROM daily
        LEFT JOIN daily_discounts USING (date, item_id, store_id)
        LEFT JOIN catalog USING (item_id) LEFT JOIN stores USING (store_id)""",
    ),
    "align_schema_union": with_views(
        "TR",
        f"""SELECT {_KEYS}, total_quantity, {_step("avg_base_price")},
        NULL AS promo_type_code, lag_7_quantity, dept_name FROM features
        UNION ALL
        SELECT {_KEYS}, NULL, {_step("avg_base_price")}, promo_type_code, NULL, dept_name
        FROM frame""",
        _FRAME,
    ),
    "enrich_dimensions": with_views(
        "BN",
        f"""SELECT {_KEYS}, total_quantity, {_list(*_ATTRIBUTES)} FROM daily
        LEFT JOIN catalog USING (item_id) LEFT JOIN stores USING (store_id)""",
    ),
    "enrich_dimensions_as_of": with_views(
        "BN",
        f"""SELECT {_KEYS}, total_quantity,
        CASE WHEN item_id LIKE '%1' AND date >= DATE '1998-02-01' AND date < DATE '2000-01-01'
             THEN 'moved ' || dept_name ELSE dept_name END AS dept_name,
        CASE WHEN item_id LIKE '%1' AND date >= DATE '2000-01-01' THEN NULL ELSE class_name END
          AS class_name, subclass_name, item_type, division, format,
        CASE WHEN store_id % 3 = 0 AND city IS NOT NULL AND date >= DATE '1998-02-01'
             THEN 'merged' ELSE city END AS city, area
        FROM daily LEFT JOIN catalog USING (item_id) LEFT JOIN stores USING (store_id)""",
    ),
    "enrich_markdowns": with_views(
        "BN",
        f"""SELECT {_KEYS}, total_quantity, coalesce(markdown_quantity, 0) AS markdown_quantity,
        {_step("avg_base_price")},
        floor(coalesce(markdown_price, 0) * 1e6 + 0.123457) / 1e6 AS markdown_price,
        floor(coalesce(markdown_normal_price, 0) * 1e6 + 0.123457) / 1e6
          AS markdown_normal_price
        FROM daily LEFT JOIN daily_markdowns USING (date, item_id, store_id)""",
    ),
    "enrich_discounts": with_views(
        "BN",
        f"""SELECT {_KEYS}, total_quantity, promo_type_code, {_step("avg_base_price")},
        floor(coalesce(promo_price, 0) * 1e6 + 0.123457) / 1e6 AS promo_price,
        floor(coalesce(discount_price_before_promo, 0) * 1e6 + 0.123457) / 1e6
          AS discount_price_before_promo
        FROM daily LEFT JOIN daily_discounts USING (date, item_id, store_id)""",
    ),
    "demand_panel": with_views(
        "BN",
        f"""SELECT {_KEYS}, total_quantity, promo_type_code, {_step(*_PRICES)} FROM (
          SELECT * REPLACE (
            coalesce(markdown_quantity, 0) AS markdown_quantity,
            coalesce(markdown_price, 0) AS markdown_price,
            coalesce(markdown_normal_price, 0) AS markdown_normal_price,
            coalesce(promo_price, 0) AS promo_price,
            coalesce(discount_price_before_promo, 0) AS discount_price_before_promo)
          FROM daily LEFT JOIN daily_markdowns USING (date, item_id, store_id)
          LEFT JOIN daily_discounts USING (date, item_id, store_id))""",
    ),
    "item_store_grid": with_views(
        "BN",
        """SELECT item_id, store_id FROM (SELECT DISTINCT item_id FROM catalog),
        (SELECT DISTINCT store_id FROM stores)""",
    ),
    "date_spine": with_views(
        "BN",
        f"""SELECT CAST(CAST({_DAY} + CAST(i AS INTEGER) AS DATE) AS VARCHAR) AS date,
        item_id, store_id
        FROM (SELECT DISTINCT item_id, store_id FROM sales), range(7) AS days(i)""",
    ),
    "daily_demand": with_views(
        "BN", f"SELECT {_KEYS}, total_quantity, {_step('avg_base_price')} FROM daily"
    ),
    "daily_markdowns": with_views(
        "BN",
        f"""SELECT {_KEYS}, markdown_quantity,
        {_step("markdown_price", "markdown_normal_price")} FROM daily_markdowns""",
    ),
    "daily_discounts": with_views(
        "BN",
        f"""SELECT {_KEYS}, promo_type_code,
        {_step("promo_price", "discount_price_before_promo")} FROM daily_discounts""",
    ),
    "stores_per_item": with_views("PR", "SELECT item_id, n_stores FROM per_item", _PR_COUNTS),
    "active_days_per_item": with_views(
        "PR", "SELECT item_id, active_days FROM per_item", _PR_COUNTS
    ),
    "rows_per_item": with_views("PR", "SELECT item_id, n_rows FROM per_item", _PR_COUNTS),
    "mean_quantity_per_item": with_views(
        "PR", "SELECT item_id, mean_quantity FROM per_item", _PR_COUNTS
    ),
    "sales_date_range": with_views(
        "BN",
        """SELECT CAST(min(date) AS VARCHAR) AS first_date,
        CAST(max(date) AS VARCHAR) AS last_date FROM sales""",
    ),
    "items_in_all_stores": with_views(
        "PR", "SELECT item_id, n_stores FROM everywhere", _PR_COUNTS
    ),
    "top_items": with_views("PR", "SELECT item_id, n_rows FROM top", _PR_COUNTS),
    "assortment_profile": with_views(
        "PR",
        "SELECT item_id, n_stores, active_days, n_rows, mean_quantity FROM top",
        _PR_COUNTS,
    ),
    "assortment_profile_by_day": with_views(
        "PR",
        "SELECT item_id, n_stores, active_days, n_rows, mean_quantity FROM top",
        _PR_COUNTS,
    ),
    "assortment_attribute_counts": with_views(
        "BN",
        """SELECT count(DISTINCT dept_name) AS n_dept_name,
        count(DISTINCT class_name) AS n_class_name,
        count(DISTINCT subclass_name) AS n_subclass_name,
        count(DISTINCT item_type) AS n_item_type
        FROM catalog WHERE item_id IN (SELECT item_id FROM top)""",
        _PR_COUNTS,
    ),
    "dummies": with_views(
        "TR",
        f"""SELECT {_D}, store_id, sum_total, """
        + ", ".join(
            f"CAST(CASE WHEN item_id = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS item_id_{v}"
            for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "UNLISTED")
        )
        + " FROM sales",
    ),
    "dummy_entries": with_views(
        "PR", f"SELECT {_D}, store_id, sum_total, 'item_id_' || item_id AS dummy FROM sales"
    ),
    "rmse": with_views(
        "TR",
        """SELECT sqrt(avg((total_quantity - lag_7_quantity) * (total_quantity - lag_7_quantity)))
        AS rmse FROM features""",
    ),
    "lag_features": with_views(
        "TR", f"SELECT {_KEYS}, total_quantity, {_list(*_SERIES[:4])} FROM series"
    ),
    "rolling_features": with_views(
        "TR", f"SELECT {_KEYS}, total_quantity, {_list(*_SERIES[4:])} FROM series"
    ),
    "calendar_features": with_views(
        "BN",
        f"""SELECT {_KEYS}, {_list(*_CALENDAR)} FROM (
          SELECT date, item_id, store_id, {CALENDAR} FROM daily)""",
    ),
    "partition_keys": with_views(
        "BN",
        f"""SELECT DISTINCT {_D}, CAST(year(date) AS INTEGER) AS year,
        CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
        strftime(date, '%Y') AS year_padded, strftime(date, '%m') AS month_padded,
        strftime(date, '%d') AS day_padded,
        strftime(date, 'year=%Y/month=%m/day=%d') AS path,
        'year=' || year(date) || '/month=' || month(date) || '/day=' || day(date)
          AS unpadded_path
        FROM sales""",
    ),
    "promotion_flag": with_views("TR", f"SELECT {_KEYS}, on_promotion FROM features"),
    "clamp_forecast": with_views(
        "TR",
        f"""SELECT {_KEYS}, CAST(greatest(trunc(
          (total_quantity - coalesce(lag_7_quantity, 0)) * CAST(0.3 AS DOUBLE)), 0) AS INTEGER)
          AS predicted_quantity FROM series""",
    ),
    "forecast_frame": with_views(
        "TR",
        f"""SELECT {_KEYS}, {_step(*_PRICES)}, promo_type_code, {_list(*_ATTRIBUTES)}
        FROM frame""",
        _FRAME,
    ),
    "forecast_frame_raw": with_views(
        "TR",
        f"""SELECT {_KEYS}, {_step(*_PRICES)}, promo_type_code, {_list(*_ATTRIBUTES)} FROM (
          SELECT grid.date, grid.item_id, grid.store_id, p.price AS avg_base_price,
                 m.quantity AS markdown_quantity, m.price AS markdown_price,
                 m.normal_price AS markdown_normal_price, d.promo_type_code,
                 d.sale_price_time_promo AS promo_price,
                 d.sale_price_before_promo AS discount_price_before_promo,
                 {_list(*_ATTRIBUTES)}
          FROM grid
          LEFT JOIN markdowns m USING (date, item_id, store_id)
          LEFT JOIN discounts d USING (date, item_id, store_id)
          LEFT JOIN prices p USING (date, item_id, store_id)
          LEFT JOIN catalog c USING (item_id) LEFT JOIN stores s USING (store_id))""",
        _GRID,
    ),
    "inference_features": with_views("TR", _INFERRED, _INFERENCE),
    "inference_features_daily": with_views("DY", _INFERRED, _INFERENCE),
    "inference_recursive": with_views(
        "TR", _INFERRED.replace(" FROM", ", predicted_quantity FROM"), _MEAN, _RECURSIVE
    ),
    "inference_features_raw": with_views("TR", _INFERRED, _raw_inference()),
    "train_model": with_views(
        "TR", f"SELECT {_KEYS}, total_quantity, prediction FROM held_out", _MEAN
    ),
    "validation_rmse": with_views(
        "TR",
        """SELECT round(sqrt(avg((total_quantity - prediction) * (total_quantity - prediction))), 6)
        AS rmse FROM held_out""",
        _MEAN,
    ),
    "train_forest": with_views(
        "TR",
        f"""SELECT {_KEYS}, total_quantity, CAST(50 AS INTEGER) AS n_trees,
        true AS loads_the_same, true AS not_negative, true AS evaluator_agrees FROM held_out""",
        _MEAN,
    ),
    "training_guard": with_views(
        "TR", "SELECT count(*) AS n_rows, true AS untrained FROM daily"
    ),
    "score_forecast": with_views(
        "TR",
        f"SELECT {_KEYS}, {ATTRIBUTES_FILLED}, predicted_quantity FROM scored",
        _FRAME,
        _SCORED,
    ),
    "publish_versions": with_views(
        "TR",
        f"""SELECT {_D}, count(*) AS n_rows,
        CAST(sum(predicted_quantity + CASE WHEN shown THEN 0 ELSE 3 END) AS BIGINT) AS units,
        CAST(2 AS INTEGER) AS n_versions, shown
        FROM scored, (VALUES (true), (false)) versions(shown) GROUP BY date, shown""",
        _FRAME,
        _SCORED,
    ),
    "publish_forecast": with_views(
        "TR",
        f"""SELECT {_D}, count(*) AS n_rows, CAST(sum(predicted_quantity) AS BIGINT) AS units
        FROM scored GROUP BY date""",
        _FRAME,
        _SCORED,
    ),
    "category_index": with_views(
        "TR",
        "SELECT column_name, value, CAST(position AS DOUBLE) AS position FROM positions",
        _VALUES,
    ),
    "category_labels": with_views(
        "PR",
        """SELECT 'item_id' AS column_name, item_id AS value, CAST(row_number() OVER (
             ORDER BY count(*) DESC, item_id) - 1 AS DOUBLE) AS position
        FROM sales GROUP BY item_id
        UNION ALL SELECT 'store_id', CAST(store_id AS VARCHAR), CAST(row_number() OVER (
             ORDER BY count(*) DESC, CAST(store_id AS VARCHAR)) - 1 AS DOUBLE)
        FROM sales GROUP BY store_id""",
    ),
    "backtest": with_views(
        "TR",
        """SELECT fold, ahead, count(*) AS n_rows,
        round(sqrt(avg((prediction - total_quantity) * (prediction - total_quantity))), 6) AS rmse,
        round(avg(prediction - total_quantity), 6) AS mean_error
        FROM scored_folds GROUP BY GROUPING SETS ((fold, ahead), (fold))""",
        """folds AS (
          SELECT CAST(i AS INTEGER) AS fold,
                 DATE '2001-06-16' - CAST(14 * (2 - i) AS INTEGER) AS cut FROM range(3) r(i)),
        fold_means AS (
          SELECT fold, cut, avg(total_quantity) AS prediction
          FROM daily, folds WHERE date <= cut GROUP BY fold, cut),
        scored_folds AS (
          SELECT fold, CAST(date - CAST(cut AS DATE) AS INTEGER) AS ahead, total_quantity, prediction
          FROM daily, fold_means WHERE date > cut AND date <= cut + 14)""",
    ),
    "category_onehot": with_views(
        "TR",
        """SELECT column_name, CAST(position AS INTEGER) AS slot,
        CAST(n_rows AS DOUBLE) AS n_rows FROM positions""",
        _VALUES,
    ),
    "assemble_features": with_views(
        "TR",
        f"SELECT {_D}, item_id, {_step(*_PRICES)}, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC if c not in _PRICES)
        + """, CAST(20 + (SELECT count(*) FROM positions) AS INTEGER) AS n_slots,
        CAST(9 AS DOUBLE) AS n_set FROM features""",
        _VALUES,
    ),
}
