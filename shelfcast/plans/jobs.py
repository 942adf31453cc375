"""The batch jobs, each from files to files.

Layout under a zone root: ``sales`` and ``recent`` (date-partitioned Parquet), ``static/<table>``,
``features`` (date-partitioned), ``manifest/<zone>`` and ``forecasts``. Jobs hand over through
these only, so a job that fails can be run again and none holds the lineage of the one before it.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import as_date, date_lit, shift
from shelfcast.operators.split import Items, select_items, select_items_static
from shelfcast.operators.profile import TOP_ITEMS
from shelfcast.operators.summaries import SUMMARY, day_summaries, profile_of_summaries
from shelfcast.plans.backtest import backtest, rolling_ends
from shelfcast.plans.corrections import corrected_features
from shelfcast.plans.features import feature_table, feature_table_for_day
from shelfcast.plans.frame import inference_features
from shelfcast.plans.recursive import recursive_forecast
from shelfcast.plans.training import (
    demand_pipeline,
    load_model,
    save_model,
    score,
    train_model,
    validation_predictions,
    validation_rmse,
)
from shelfcast.schemas import (
    CATEGORY_INPUTS,
    DIMENSION_KEYS,
    FEATURES,
    FORECAST_COLUMNS,
    HORIZON_DAYS,
    LOOKBACK_DAYS,
    RECENT_DAYS,
    SALES,
    STATIC_TABLES,
    conform,
)
from shelfcast.sources.compaction import FILE_BYTES, compact
from shelfcast.sources.publish import publish_jdbc, publish_parquet, publish_version
from shelfcast.sources.rejects import TooManyRejects, accepted, counted, parse_csv, settle
from shelfcast.sources.tables import (
    land_static,
    land_versions,
    read_csv,
    read_sales,
    read_static,
    read_versions,
)
from shelfcast.sources.zones import (
    between_dates,
    folder_exists,
    last_date,
    last_version,
    next_dates,
    on_dates,
    per_date,
    read_manifest,
    read_zone,
    record_counts,
    record_dates,
    remove_dates,
    remove_folder,
    replace_folder,
    stale_dates,
    write_by_date,
)

log = logging.getLogger(__name__)


class NothingToLand(ValueError):
    """A landing that would leave a zone without rows."""


class NothingToForecast(ValueError):
    """A date without the sales or the history a forecast would be made from."""


def manifest_path(root: str, zone: str) -> str:
    return f"{root}/manifest/{zone}"


def land_history(
    spark: SparkSession,
    raw: str,
    root: str,
    items: Items = None,
    max_rejected: float = 0.0,
    landed_on: str | dt.date | None = None,
) -> None:
    """Raw CSVs to zones: sales split into history and recent dates, side tables. All items
    unless some are given. Side files that are not there are passed over. Sales that do not parse
    go to ``rejects/sales`` under the date they are landed on, today unless given; if they are
    more than the share ``max_rejected`` of all rows, the job raises and the zone stays.

    The text is parsed once, into a folder beside the sales zone, whose footers give the dates
    and counts; the cut, the manifest and the dates to hold back come from those. Recent dates are
    copied by date and taken out, and only then the folder takes the zone's place. If it has no
    rows the job raises, and what was landed before stays.
    """
    parsed = parse_csv(spark, f"{raw}/sales.csv", SALES)
    watched, seen = counted(parsed, "sales")
    sales = select_items(accepted(watched, SALES), items)
    zone, manifest = f"{root}/sales", manifest_path(root, "sales")
    beside = f"{zone}-{uuid.uuid4().hex}"
    write_by_date(sales, beside, mode="overwrite", padded=True)
    written = read_zone(spark, beside, SALES)
    counts = {r["date"]: r["n_rows"] for r in per_date(written).collect() if r["date"]}
    on = landed_on or dt.date.today()
    try:
        settle(parsed, seen if counts else None, f"{root}/rejects", "sales", on, max_rejected)
    except TooManyRejects:
        remove_folder(spark, beside)
        raise
    if not counts:
        remove_folder(spark, beside)
        raise NothingToLand(f"no sales of the chosen items in {raw}; {zone} is as it was")
    cut = shift(max(counts), -RECENT_DAYS)
    recent = between_dates(written, cut).select(*SALES.names)
    write_by_date(recent, f"{root}/recent", mode="overwrite", padded=True)
    remove_dates(spark, beside, [day for day in counts if day >= cut])
    replace_folder(spark, beside, zone)
    kept = [(day, n) for day, n in counts.items() if day < cut]
    landed = spark.createDataFrame(kept, "date date, n_rows long")
    record_counts(landed, manifest, mode="overwrite")
    land_static(select_items_static(_side_files(spark, raw), items), f"{root}/static")


def arrivals_of(
    spark: SparkSession,
    path: str,
    root: str,
    landed_on: str | dt.date | None = None,
    max_rejected: float = 0.0,
) -> DataFrame:
    """Sales of a CSV that arrived, parsed once into a folder under ``root``; rows that do not
    parse go to the reject zone, and raise if they are too many. Parquet is read as it is."""
    if not path.rstrip("/").endswith((".csv", ".csv.gz")):
        return read_sales(spark, path)
    parsed = parse_csv(spark, path, SALES)
    watched, seen = counted(parsed, "arrivals")
    sales = _stored_under(f"{root}/work/arrivals-{uuid.uuid4().hex}")(accepted(watched, SALES), "sales")
    on = landed_on or dt.date.today()
    settle(parsed, None if sales.isEmpty() else seen, f"{root}/rejects", "sales", on, max_rejected)
    return sales


def land_side_tables(
    spark: SparkSession,
    raw: str,
    root: str,
    items: Items = None,
    holds_from: str | dt.date | None = None,
) -> list[str]:
    """Side tables by themselves, as new items, plans and prices arrive after the history. Dated
    tables are replaced by date. Items and stores hold from ``holds_from``, today unless given:
    those that are new are added, those that changed get a version from that day and keep the
    older one for dates before. Tables without a file, and tables whose file has no row that is
    chosen, stay as they are. Returns the names of those landed."""
    found = select_items_static(_side_files(spark, raw), items)
    chosen = {name: df for name, df in found.items() if not df.isEmpty()}
    for name in found.keys() - chosen.keys():
        log.warning("%s.csv in %s has no row to land; the table stays as it is", name, raw)
    static = f"{root}/static"
    for name in DIMENSION_KEYS.keys() & chosen.keys():
        rows = conform(chosen[name], STATIC_TABLES[name])
        land_versions(rows, static, name, holds_from or dt.date.today())
    dated = {n: df for n, df in chosen.items() if n not in DIMENSION_KEYS}
    land_static(dated, static, mode="replace_dates")
    return sorted(chosen)


def _side_files(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    found = {}
    for name, schema in STATIC_TABLES.items():
        try:
            found[name] = read_csv(spark, f"{raw}/{name}.csv", schema, keep_rest=True)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("%s.csv is not in %s; passed over", name, raw)
    return found


def land_day(
    arrivals: DataFrame, sales_zone: str, day: str | dt.date, manifest: str | None = None
) -> int:
    """Land one date of the arrivals, replacing that date if it was landed before; returns the
    rows the zone then has for it. A date without rows changes nothing."""
    spark = arrivals.sparkSession
    rows = between_dates(arrivals, day, day).select(*SALES.names)
    write_by_date(rows, sales_zone, mode="replace_dates", padded=True)
    landed = between_dates(read_zone(spark, sales_zone, SALES), day, day)
    if manifest is not None:
        record_dates(landed, manifest)
    return landed.count()


def _manifests(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    sales, features = (read_manifest(spark, manifest_path(root, z)) for z in ("sales", "features"))
    return sales, features


def _past_is_whole(spark: SparkSession, root: str, day: dt.date) -> bool:
    """Whether the feature zone has every date of the look-back that the sales have, built from
    the sales as they were last landed."""
    sales, features = (
        between_dates(manifest, shift(day, -LOOKBACK_DAYS), shift(day, -1))
        for manifest in _manifests(spark, root)
    )
    return stale_dates(sales, features).isEmpty() and not features.isEmpty()


def _sides(spark: SparkSession, root: str) -> list[DataFrame]:
    """Items and stores as versions, and the markdowns and discounts."""
    static = f"{root}/static"
    plans = [read_static(spark, static, name) for name in ("markdowns", "discounts_history")]
    return [*(read_versions(spark, static, name) for name in DIMENSION_KEYS), *plans]


def _stored_under(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that writes a frame under a name in a folder and reads it back."""

    def store_rows(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return store_rows


def correct_features(
    spark: SparkSession, root: str, until: str | dt.date | None = None
) -> list[dt.date]:
    """Bring sales that were landed again, or late, into the feature zone: the dates whose sales
    record is newer than what their features were built from, up to ``until`` or the last date
    the zone has, and every later date one of their changes reaches. Other dates are not
    rewritten. Returns the dates that were. An empty feature zone is left to a full build."""
    sales, features = _manifests(spark, root)
    last = last_date(features).first()[0]
    if last is None:
        return []
    version = last_version(spark, manifest_path(root, "sales"))
    late = between_dates(stale_dates(sales, features), None, until or last)
    dates = sorted(r["date"] for r in late.collect())
    if not dates:
        return []
    zone, work = f"{root}/features", f"{root}/work/corrections-{uuid.uuid4().hex}"
    rows, touched = corrected_features(
        read_zone(spark, zone, FEATURES),
        read_zone(spark, f"{root}/sales", SALES),
        *_sides(spark, root),
        dates,
        _stored_under(work),
    )
    write_by_date(rows, zone)
    record_dates(
        on_dates(read_zone(spark, zone, FEATURES), touched),
        manifest_path(root, "features"),
        source=version,
    )
    remove_folder(spark, work)
    return touched


def build_features(
    spark: SparkSession,
    root: str,
    process_date: str | dt.date | None = None,
    mode: str | None = None,
) -> None:
    """Features of the whole history, or of one date from its look-back. A one-date run
    replaces that date and no other unless told otherwise. It takes the past from the feature
    zone if that has all of it as it was last landed, else from the sales."""
    sales = read_zone(spark, f"{root}/sales", SALES)
    side = _sides(spark, root)
    zone, manifest = f"{root}/features", manifest_path(root, "features")
    version = last_version(spark, manifest_path(root, "sales"))
    if process_date is None:
        write_by_date(feature_table(sales, *side), zone, mode=mode or "overwrite")
        record_dates(read_zone(spark, zone, FEATURES), manifest, "overwrite", version)
        return
    day = as_date(process_date)
    whole = _past_is_whole(spark, root, day)
    history = read_zone(spark, zone, FEATURES) if whole else None
    features = feature_table_for_day(sales, *side, day, history=history)
    write_by_date(features, zone, mode=mode or "replace_dates")
    written = read_zone(spark, zone, FEATURES)
    if mode == "overwrite":
        record_dates(written, manifest, "overwrite", version)
    else:
        record_dates(between_dates(written, day, day), manifest, source=version)


def refresh_profile(spark: SparkSession, root: str, top: int = TOP_ITEMS) -> DataFrame:
    """The assortment profile, kept up by day: the dates that were landed since they were last
    summarised are read and summarised, all others are taken from their summaries. Those that
    hold stores in another form, under ``profile``, are not read: their dates are summarised anew."""
    sales, done = manifest_path(root, "sales"), manifest_path(root, "summaries")
    version = last_version(spark, sales)
    late = stale_dates(read_manifest(spark, sales), read_manifest(spark, done))
    dates = [r["date"] for r in late.collect()]
    zone = f"{root}/summaries"
    if dates:
        rows = on_dates(read_zone(spark, f"{root}/sales", SALES), dates)
        write_by_date(day_summaries(rows), zone)
        record_dates(on_dates(read_zone(spark, zone, SUMMARY), dates), done, source=version)
    return profile_of_summaries(read_zone(spark, zone, SUMMARY), top)


def compact_zones(spark: SparkSession, root: str, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the dates of the sales and feature zones that have too many files; returns how
    many dates."""
    zones = {"sales": SALES, "features": FEATURES}
    here = {name: s for name, s in zones.items() if folder_exists(spark, f"{root}/{name}")}
    return sum(len(compact(spark, f"{root}/{name}", s, file_bytes)) for name, s in here.items())


def train(
    spark: SparkSession,
    root: str,
    model_path: str,
    training_end: str | dt.date | None = None,
    without: Sequence[str] = (),
    folds: int = 0,
) -> float | None:
    """Fit on the feature zone, store the model, return the hold-out error. Training ends
    with the last date landed unless a date is given. Categories named in ``without`` are no
    inputs. With ``folds``, models are also fitted up to as many earlier cuts, a hold-out apart,
    and their errors by fold and day are stored beside the model, at ``<model>-errors``."""
    end = training_end or last_date(read_manifest(spark, manifest_path(root, "sales"))).first()[0]
    features = read_zone(spark, f"{root}/features", FEATURES)
    unknown = set(without) - set(CATEGORY_INPUTS)
    if unknown:
        raise ValueError(f"no category input: {', '.join(sorted(unknown))}")
    pipeline = demand_pipeline(columns=[c for c in CATEGORY_INPUTS if c not in without])
    model = train_model(features, end, pipeline=pipeline)
    if model is None:
        return None
    save_model(model, model_path)
    if folds:
        errors = backtest(features, rolling_ends(end, folds), pipeline=pipeline)
        errors.coalesce(1).write.mode("overwrite").parquet(f"{model_path}-errors")
    return validation_rmse(validation_predictions(model, features, end))


def forecast(
    spark: SparkSession,
    root: str,
    model_path: str,
    start: str | dt.date,
    days: int = HORIZON_DAYS,
    table: str | None = None,
    jdbc_url: str | None = None,
    plan: str = "aggregate",
    feed_back: bool = False,
    **jdbc_options: str,
) -> DataFrame:
    """Score the horizon once, write it as Parquet, and publish tables from those files. A
    start without any history before it raises; an empty forecast leaves what was published
    as it is. With ``feed_back`` the days are scored one after the other, each seeing what was
    forecast for those before it; plans are then aggregated."""
    if feed_back and plan != "aggregate":
        raise ValueError("forecasts are fed back with the plan 'aggregate' only")
    sides = [*_sides(spark, root), read_static(spark, f"{root}/static", "price_history")]
    history = read_zone(spark, f"{root}/features", FEATURES)
    past = between_dates(history, shift(start, -1 - LOOKBACK_DAYS), shift(start, -1))
    if past.isEmpty():
        raise NothingToForecast(f"the feature zone has no date in the look-back of {start}")
    work = f"{root}/work/forecast-{uuid.uuid4().hex}"
    if feed_back:
        model = load_model(model_path)
        found = recursive_forecast(model, history, *sides, start, _stored_under(work), days)
        scored = found.select(*FORECAST_COLUMNS)
    else:
        rows = inference_features(history, *sides, start, days, plan=plan)
        scored = score(load_model(model_path), rows)
    written = spark.read.schema(scored.schema).parquet(
        publish_parquet(scored, f"{root}/forecasts", start)
    )
    remove_folder(spark, work)
    if written.isEmpty():
        log.warning("nothing to forecast from %s; published tables stay as they are", start)
        return written
    if table is not None:
        publish_version(written, f"{root}/published", table)
    if jdbc_url is not None:
        publish_jdbc(written, jdbc_url, **jdbc_options)
    return written


def run_daily(
    spark: SparkSession,
    root: str,
    model_path: str,
    process_date: str | dt.date | None = None,
    arrivals: DataFrame | None = None,
    **publishing: str,
) -> DataFrame:
    """One day's run: land it, bring corrected past days into the features, build those of the
    day, forecast from the day after. The date is
    the one after the last in the feature zone. Sales come from ``arrivals``, or from the
    recent dates held back when the history was landed. A date without sales stops the run:
    give the date after it to pass over it."""
    if process_date is None:
        done = read_manifest(spark, manifest_path(root, "features"))
        process_date = next_dates(done).first()["process_date"]
        if process_date is None:
            raise NothingToForecast("the feature zone is empty")
    day = as_date(process_date)
    if arrivals is None:
        arrivals = read_zone(spark, f"{root}/recent", SALES)
    if not land_day(arrivals, f"{root}/sales", day, manifest_path(root, "sales")):
        raise NothingToForecast(
            f"no sales of {day}: to pass over that date, give {shift(day, 1)} as the process date"
        )
    correct_features(spark, root, shift(day, -1))
    build_features(spark, root, day)
    return forecast(spark, root, model_path, shift(day, 1), **publishing)
