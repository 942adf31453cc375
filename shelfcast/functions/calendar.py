"""Date arithmetic, calendar columns and partition keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date) -> dt.date:
    """A job argument given as ``YYYY-MM-DD`` text or as a date."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def shift(value: str | dt.date, days: int) -> dt.date:
    return as_date(value) + dt.timedelta(days=days)


def date_lit(value: str | dt.date) -> Column:
    return F.lit(as_date(value))


def parse_date(text: Column) -> Column:
    """A date from ISO text; a time that follows it is left out. Other text raises."""
    dated = text.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$")
    return F.to_date(F.when(dated, F.substring(text, 1, 10)).otherwise(text), "yyyy-MM-dd")


def calendar_columns(day: str = "date") -> dict[str, Column]:
    """Weekday (Sunday 1 to Saturday 7), month, calendar year, ISO week, weekend flag and
    day of month."""
    d = F.col(day)
    weekday = F.dayofweek(d)
    return {
        "day_of_week": weekday,
        "month": F.month(d),
        "year": F.year(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": weekday.isin(1, 7).cast("int"),
        "day": F.dayofmonth(d),
    }


def date_parts(day: str = "date", padded: bool = False) -> dict[str, Column]:
    """Partition keys of a date: integers, or zero-padded text for ``month=08`` style
    directories."""
    d = F.col(day)
    if padded:
        return {
            "year": F.date_format(d, "yyyy"),
            "month": F.date_format(d, "MM"),
            "day": F.date_format(d, "dd"),
        }
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def partition_path(day: str = "date", padded: bool = True) -> Column:
    """``year=YYYY/month=MM/day=DD`` of a date."""
    parts = date_parts(day, padded)
    return F.concat_ws(
        "/", *[F.concat(F.lit(f"{name}="), part.cast("string")) for name, part in parts.items()]
    )
