"""Small hand-made tables and a plain-Python rendering of the series windows."""

import datetime as dt
import random
import uuid

from shelfcast import schemas

DAY = dt.date(2024, 1, 1)


def day(n: int) -> dt.date:
    return DAY + dt.timedelta(days=n)


def sales(spark, rows):
    """rows: (day number, item, store, quantity, price)."""
    data = [(day(n), item, q, p, None, store) for n, item, store, q, p in rows]
    return spark.createDataFrame(data, schemas.SALES)


def markdowns(spark, rows=()):
    """rows: (day number, item, store, quantity, price, normal price)."""
    return spark.createDataFrame([(day(n), *rest) for n, *rest in rows], schemas.MARKDOWNS)


def discounts(spark, rows=()):
    """rows: (day number, item, store, code, promotion price, price before)."""
    return spark.createDataFrame([(day(n), *rest) for n, *rest in rows], schemas.DISCOUNTS)


def prices(spark, rows=()):
    return spark.createDataFrame([(day(n), *rest) for n, *rest in rows], schemas.PRICES)


def catalog(spark, *items):
    return spark.createDataFrame(
        [(i, f"dept {i}", "class", f"sub {i}", "type") for i in items], schemas.CATALOG
    )


def stores(spark, *ids):
    return spark.createDataFrame(
        [(s, f"division {s % 2}", "format", f"city {s}", "area") for s in ids], schemas.STORES
    )


def stored(spark, df, folder):
    """The frame read back from a file, so that Spark knows its size."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def expected_series(values):
    """For one series in date order: per row the lags and means, as the features have them."""
    rows = []
    for i in range(len(values)):
        row = {f"lag_{n}_quantity": values[i - n] if i >= n else None for n in schemas.LAGS}
        for n in schemas.MEANS:
            seen = [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]
            row[f"rolling_mean_{n}_quantity"] = sum(seen) / len(seen) if seen else None
        rows.append(row)
    return rows


def hot_sales(spark, n_rows=3000, seed=7):
    """Sales of which item ``hot`` holds more than a third."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n_rows):
        item = "hot" if rng.random() < 0.4 else f"item {rng.randrange(20)}"
        price = rng.choice([None, 2.5, 4.0])
        rows.append((rng.randrange(60), item, rng.randrange(5), float(rng.randrange(9)), price))
    return sales(spark, rows)
