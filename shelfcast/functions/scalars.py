"""Scalar expressions of the feature and forecast jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def promotion_flag(
    promo_code: str = "promo_type_code", markdown_quantity: str = "markdown_quantity"
) -> Column:
    """1 when a promotion code is set or goods went at markdown, else 0. The markdown
    quantity counts as 0 where it is missing, so the flag is never null."""
    marked_down = F.coalesce(F.col(markdown_quantity), F.lit(0.0)) > 0
    return (F.col(promo_code).isNotNull() | marked_down).cast("int")


def whole_units(prediction: Column) -> Column:
    """A predicted quantity as a whole number, cut toward zero and never negative."""
    units = prediction.cast("int")
    return F.when(units < 0, F.lit(0)).otherwise(units)
