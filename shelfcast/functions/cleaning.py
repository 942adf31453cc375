"""Null handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from shelfcast.schemas import TARGET, UNKNOWN

STRAY_INDEX = "Unnamed: 0"


def fill_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Nulls of the named numeric columns become 0. Text columns are left alone and a
    name the frame lacks raises, as ``na.fill`` does."""
    return df.na.fill(0, subset=list(columns))


def fill_categories(df: DataFrame, columns: Iterable[str], value: str = UNKNOWN) -> DataFrame:
    """Nulls of the named text columns become ``value``; absent and numeric columns are
    passed over."""
    present = [c for c in columns if c in df.columns]
    return df.na.fill(value, subset=present) if present else df


def drop_missing_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.na.drop(subset=[target])


def drop_stray_index(df: DataFrame) -> DataFrame:
    return df.drop(STRAY_INDEX)
