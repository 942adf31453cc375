"""Item and store rows that hold from a date to a date, and joins as of a row's date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import date_lit

VALID_FROM, VALID_TO = "valid_from", "valid_to"
VALIDITY = [VALID_FROM, VALID_TO]


def versioned(dimension: DataFrame) -> DataFrame:
    """A plain dimension as versions that have always held and still do."""
    open_end = {c: F.lit(None).cast("date") for c in VALIDITY if c not in dimension.columns}
    return dimension.withColumns(open_end) if open_end else dimension


def merge_versions(
    versions: DataFrame, arrived: DataFrame, key: str, day: str | dt.date
) -> DataFrame:
    """The versions of a dimension once rows that hold from ``day`` on have arrived.

    A key whose attributes differ from those that hold on that day gets a version from the day,
    which ends the one that held; the same attributes change nothing, keys that did not arrive
    stay as they are, and a key that is new has always held, for nothing earlier is known of it.
    Rows that arrive for a day before an existing version hold until that one begins. Arriving
    twice changes nothing. One row a key is to arrive; of several the greatest by its attributes
    is taken. All joins are on the key alone.
    """
    attributes = [c for c in versions.columns if c not in (key, *VALIDITY)]
    versions = versioned(versions)
    described = F.struct(*attributes)
    new = arrived.groupBy(key).agg(F.max(described).alias("_new"))
    first = date_lit(day)
    holds = (F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= first)) & (
        F.col(VALID_TO).isNull() | (F.col(VALID_TO) > first)
    )
    begins = F.col(VALID_FROM).eqNullSafe(first)
    joined = versions.join(new, key, "full").withColumns(
        {"_known": F.coalesce(holds, F.lit(False)), "_old": described}
    )
    changes = F.col("_known") & F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))

    def version(attribute_row: Column, since: Column, until: Column) -> Column:
        fields = [F.col(key), *[attribute_row[c].alias(c) for c in attributes]]
        return F.struct(*fields, since.alias(VALID_FROM), until.alias(VALID_TO))

    never = F.lit(None).cast("date")
    here = versions.select(key).withColumn("_here", F.lit(True)).distinct()
    joined = joined.join(here, key, "left")
    as_is = version(F.col("_old"), F.col(VALID_FROM), F.col(VALID_TO))
    ended = version(F.col("_old"), F.col(VALID_FROM), first)
    begun = version(F.col("_new"), first, F.col(VALID_TO))
    unknown = version(F.col("_new"), never, never)
    rows = (
        F.when(F.col("_here").isNull(), F.array(unknown))
        .when(changes & begins, F.array(begun))
        .when(changes, F.array(ended, begun))
        .otherwise(F.array(as_is))
    )
    return joined.select(F.explode(rows).alias("row")).select("row.*")


def join_as_of(facts: DataFrame, versions: DataFrame, key: str, date: str = "date") -> DataFrame:
    """Each fact with the version of its key that holds on its date; nulls where none does.

    An equi-join on the key with a range on the date beside it: Spark broadcasts the versions if
    they are small and else shuffles by key, and a hot key is on the left, which adaptive
    execution can cut. A key has one version for any date, so no fact is repeated. A dimension
    without validity is joined by key alone.
    """
    if not set(VALIDITY) <= set(versions.columns):
        return facts.join(versions, key, "left")
    named = versions.withColumnsRenamed({key: "_key", VALID_FROM: "_from", VALID_TO: "_to"})
    holds = (
        (F.col(key) == F.col("_key"))
        & (F.col("_from").isNull() | (F.col(date) >= F.col("_from")))
        & (F.col("_to").isNull() | (F.col(date) < F.col("_to")))
    )
    return facts.join(named, holds, "left").drop("_key", "_from", "_to")


def current(versions: DataFrame) -> DataFrame:
    """The rows that hold now, without their dates."""
    if not set(VALIDITY) <= set(versions.columns):
        return versions
    return versions.where(F.col(VALID_TO).isNull()).drop(*VALIDITY)
