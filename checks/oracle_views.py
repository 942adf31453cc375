"""The retail tables and the shared derivations as DuckDB common table expressions."""

from __future__ import annotations

_PARITY = "'part ' || (p_partkey % 2)"
_GRAIN = {
    "TR": ("p_type", "n_regionkey"),
    "BN": ("p_brand", "n_nationkey"),
    "PR": ("CAST(p_partkey AS VARCHAR)", "n_regionkey"),
    "DY": (_PARITY, "0"),
}


def _dimensions(grain: str) -> str:
    item, store = _GRAIN[grain]
    other = "p_brand" if grain == "TR" else "p_type"
    if grain == "BN":
        figures = "r_name AS division, n_name AS city, CAST(n_regionkey AS VARCHAR) AS area"
        group = ""
    else:
        figures = (
            "min(r_name) AS division, min(n_name) AS city, "
            "CAST(count(n_nationkey) AS VARCHAR) AS area"
        )
        group = " GROUP BY 1"
    return f"""
catalog AS (
  SELECT {item} AS item_id, min({other}) AS dept_name, max({other}) AS class_name,
         min(p_name) AS subclass_name, max(p_name) AS item_type
  FROM part GROUP BY 1),
stores AS (
  SELECT *, CASE WHEN store_id % 2 = 0 THEN 'even' ELSE 'odd' END AS format FROM (
    SELECT CAST({store} AS INTEGER) AS store_id, {figures}
    FROM nation JOIN region ON n_regionkey = r_regionkey{group}))"""


def _line_keys(grain: str) -> str:
    item, store = _GRAIN[grain]
    if grain == "PR":
        return f"{item} AS item_id, {store} AS store_id"
    return f"""
         CASE WHEN l_linenumber = 5 AND l_tax = 0.08 THEN 'UNLISTED' ELSE {item} END AS item_id,
         CAST(CASE WHEN l_linenumber = 6 AND l_tax = 0.08 THEN -1 ELSE {store} END AS INTEGER)
           AS store_id"""


def views(grain: str) -> str:
    return f"""
lines AS (
  SELECT CAST(l_shipdate AS DATE) AS date, {_line_keys(grain)},
         l_extendedprice / l_quantity AS unit_price, lineitem.*
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
sales AS (
  SELECT date, item_id, store_id,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS quantity,
         CASE WHEN l_tax <> 0.08 THEN unit_price END AS price_base,
         l_extendedprice AS sum_total
  FROM lines),
markdowns AS (
  SELECT date, item_id, store_id, l_quantity AS quantity,
         unit_price * (1 - l_discount) AS price, unit_price AS normal_price
  FROM lines WHERE l_discount >= 0.08),
discounts AS (
  SELECT date, item_id, store_id, CAST(l_linenumber AS DOUBLE) AS promo_type_code,
         unit_price * (1 - l_discount) AS sale_price_time_promo,
         unit_price AS sale_price_before_promo
  FROM lines WHERE l_returnflag = 'R'),
prices AS (
  SELECT date, item_id, store_id, unit_price AS price
  FROM lines WHERE l_returnflag = 'A'),{_dimensions(grain)},
daily AS (
  SELECT date, item_id, store_id, sum(coalesce(quantity, 0)) AS total_quantity,
         avg(coalesce(price_base, 0)) AS avg_base_price
  FROM sales GROUP BY ALL),
daily_markdowns AS (
  SELECT date, item_id, store_id, sum(coalesce(quantity, 0)) AS markdown_quantity,
         avg(coalesce(price, 0)) AS markdown_price,
         avg(coalesce(normal_price, 0)) AS markdown_normal_price
  FROM markdowns GROUP BY ALL),
daily_discounts AS (
  SELECT date, item_id, store_id, max(promo_type_code) AS promo_type_code,
         avg(sale_price_time_promo) AS promo_price,
         avg(sale_price_before_promo) AS discount_price_before_promo
  FROM discounts GROUP BY ALL),
daily_prices AS (
  SELECT date, item_id, store_id, avg(price) AS avg_base_price FROM prices GROUP BY ALL),
series AS (
  SELECT *,
         lag(total_quantity, 7) OVER w AS lag_7_quantity,
         lag(total_quantity, 30) OVER w AS lag_30_quantity,
         lag(total_quantity, 90) OVER w AS lag_90_quantity,
         lag(total_quantity, 365) OVER w AS lag_365_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS rolling_mean_7_quantity,
         avg(total_quantity) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS rolling_mean_30_quantity
  FROM daily WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date)),
features AS ({finished("series")})"""


CALENDAR = """
CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
CAST(CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
CAST(day(date) AS INTEGER) AS day"""

_SERIES_FILLED = ",\n  ".join(
    f"coalesce({c}, 0) AS {c}"
    for c in (
        "lag_7_quantity",
        "lag_30_quantity",
        "lag_90_quantity",
        "lag_365_quantity",
        "rolling_mean_7_quantity",
        "rolling_mean_30_quantity",
    )
)
ATTRIBUTES_FILLED = ", ".join(
    f"coalesce({c}, 'unknown') AS {c}"
    for c in (
        "dept_name",
        "class_name",
        "subclass_name",
        "item_type",
        "division",
        "format",
        "city",
        "area",
    )
)


def finished(rows: str, price: str = "avg_base_price") -> str:
    """Feature rows from ``rows``, which has the keys, target and window columns."""
    return f"""
  SELECT date, item_id, store_id, total_quantity,
  coalesce({price}, 0) AS avg_base_price,
  coalesce(markdown_quantity, 0) AS markdown_quantity,
  coalesce(markdown_price, 0) AS markdown_price,
  coalesce(markdown_normal_price, 0) AS markdown_normal_price,
  coalesce(promo_price, 0) AS promo_price,
  coalesce(discount_price_before_promo, 0) AS discount_price_before_promo,
  CAST(CASE WHEN promo_type_code IS NOT NULL OR coalesce(markdown_quantity, 0) > 0
       THEN 1 ELSE 0 END AS INTEGER) AS on_promotion,
  {CALENDAR},
  {_SERIES_FILLED},
  {ATTRIBUTES_FILLED}
  FROM {rows}
  LEFT JOIN daily_markdowns USING (date, item_id, store_id)
  LEFT JOIN daily_discounts USING (date, item_id, store_id)
  LEFT JOIN catalog USING (item_id)
  LEFT JOIN stores USING (store_id)"""


def with_views(grain: str, query: str, *extra: str) -> str:
    return "WITH " + ",".join([views(grain), *(f"\n{e}" for e in extra)]) + "\n" + query
