"""Rows of a CSV that do not parse: kept aside with what is wrong, instead of a stop."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
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

from shelfcast.functions.calendar import date_lit
from shelfcast.functions.cleaning import STRAY_INDEX
from shelfcast.sources.zones import write_by_date

PROBLEMS = "problems"
_LINE = "_line"
_PROBLEM = "array<struct<column: string, text: string, reason: string>>"
REJECTS = f"date date, table_name string, file string, line string, {PROBLEMS} {_PROBLEM}"


class TooManyRejects(ValueError):
    """More rows of a file do not parse than its landing allows."""


def _parsed(name: str, kind: DataType) -> tuple[Column, str]:
    """A text column in its type, null where the text is of another, and what to say then."""
    text = F.col(f"`{name}`")
    if isinstance(kind, DateType):
        dated = text.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$")
        return F.when(dated, F.substring(text, 1, 10).try_cast("date")), "not a date"
    if isinstance(kind, IntegerType):
        number = text.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int")), "not a whole number"
    if isinstance(kind, DoubleType):
        return text.try_cast("double"), "not a number"
    return text.cast(kind), "not of its type"


def parse_csv(
    spark: SparkSession, path: str, schema: StructType, required: Iterable[str] = ("date",)
) -> DataFrame:
    """A CSV file or folder with a header, in the types of ``schema``, with the ``file`` and the
    text of each row as ``line`` and its ``problems``: a column, its text and a reason for each
    value that is not of its type, each required column that is empty, and for a row whose number
    of fields is not the header's. Rows without problems have an empty list. One pass, no shuffle.

    Columns are found by the names of the header, which the files of a folder share. A column of
    the schema that it lacks raises.
    """
    header = spark.read.csv(path, header=True, enforceSchema=False).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = StructType([*(StructField(c, StringType()) for c in header), StructField(_LINE, StringType())])
    # With column pruning the parser does not count the fields of a row.
    reader = spark.read.schema(kinds).option("columnPruning", False)
    text = reader.csv(
        path, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE
    )
    typed, problems = {}, []

    def problem(name: str, value: Column, reason: str) -> Column:
        fields = F.lit(name).alias("column"), value.alias("text"), F.lit(reason).alias("reason")
        return F.struct(*fields)

    for field in schema:
        value, reason = _parsed(field.name, field.dataType)
        typed[field.name] = value
        raw = F.col(f"`{field.name}`")
        problems.append(F.when(raw.isNotNull() & value.isNull(), problem(field.name, raw, reason)))
        if field.name in set(required):
            problems.append(F.when(raw.isNull(), problem(field.name, raw, "missing")))
    torn = F.col(_LINE).isNotNull()
    whole = F.array(problem("", F.col(_LINE), "wrong number of fields"))
    found = F.when(torn, whole).otherwise(F.array_compact(F.array(*problems))).cast(_PROBLEM)
    names = [c for c in header if c != STRAY_INDEX]
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    return text.select(
        *[value.alias(name) for name, value in typed.items()],
        F.col("_metadata.file_name").alias("file"),
        line.alias("line"),
        found.alias(PROBLEMS),
    )


def accepted(parsed: DataFrame, schema: StructType) -> DataFrame:
    return parsed.where(F.size(PROBLEMS) == 0).select(*schema.names)


def rejected(parsed: DataFrame, table: str, day: str | dt.date) -> DataFrame:
    """The rows that do not parse, dated by when they were landed."""
    bad = parsed.where(F.size(PROBLEMS) > 0)
    return bad.select(date_lit(day).alias("date"), F.lit(table).alias("table_name"), "file", "line", PROBLEMS)


def counted(parsed: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows; once they have been used, the observation has ``n_read`` and ``n_bad``."""
    seen = Observation(name)
    bad = F.count_if(F.size(PROBLEMS) > 0).alias("n_bad")
    return parsed.observe(seen, F.count("*").alias("n_read"), bad), seen


def settle(
    parsed: DataFrame,
    seen: Observation | None,
    zone: str,
    table: str,
    day: str | dt.date,
    most: float,
) -> int:
    """After the accepted rows were written: put the others into the reject zone, which has a
    folder for each table, and raise if they are more than the share ``most`` of all. The file is
    only read a second time if there are any, or if nothing was written: then Spark may have left
    out the step that counts, and ``seen`` is to be None. Landing a table twice on one day
    replaces that day's rejects."""
    if seen is None:
        bad = F.count_if(F.size(PROBLEMS) > 0)
        n_read, n_bad = parsed.agg(F.count("*"), bad).first()
    else:
        n_read, n_bad = seen.get["n_read"], seen.get["n_bad"]
    if not n_bad:
        return 0
    write_by_date(rejected(parsed, table, day), f"{zone}/{table}")
    if n_bad > most * n_read:
        raise TooManyRejects(
            f"{n_bad} of {n_read} rows of {table} do not parse, more than a share of {most}; "
            f"they are in {zone}/{table}"
        )
    return n_bad
