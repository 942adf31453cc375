"""Every operator as a query over the driver's tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from checks.views import FORECAST_START, PROCESS_DATE, TRAINING_END, Retail
from shelfcast.functions.calendar import (
    as_date,
    calendar_columns,
    date_lit,
    date_parts,
    parse_date,
    partition_path,
    shift,
)
from shelfcast.functions.cleaning import drop_missing_target, fill_categories, fill_numeric
from shelfcast.functions.scalars import promotion_flag, whole_units
from shelfcast.functions.series import lag_columns, rolling_mean_columns
from shelfcast.operators import aggregates, enrich, profile, split, summaries
from shelfcast.operators.joins import item_store_grid
from shelfcast.plans import features as feature_plans
from shelfcast.plans import backtest, corrections, frame, jobs, labels, recursive, training
from shelfcast.schemas import (
    ATTRIBUTES,
    CATEGORY_INPUTS,
    FEATURE_COLUMNS,
    FEATURES,
    KEYS,
    NUMERIC_INPUTS,
    PRICE_COLUMNS,
    SALES,
    SERIES,
    STATIC_TABLES,
    TARGET,
)
from shelfcast.sources import publish, rejects, tables, workspace, zones
from shelfcast.streaming import landing

ITEMS = [f"Brand#{n}" for n in range(1, 11)]
_MEAN_PRICES = [c for c in PRICE_COLUMNS if c != "markdown_quantity"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "UNLISTED"]


def _out(df: DataFrame, *mean_prices: str) -> DataFrame:
    """Dates as ISO text, and mean prices to six decimals. The order in which a float sum adds
    up moves its last digits; many unit prices end in a 5 at the seventh decimal, so the steps
    are cut off those ends, where ``round`` would fall either way."""
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType == DateType()}
    steps = {c: F.floor(F.col(c) * F.lit(1e6) + F.lit(0.123457)) / F.lit(1e6) for c in mean_prices}
    changed = {**dates, **steps}
    return df.withColumns(changed) if changed else df


_OWN_FOLDER: list[str] = []


def fresh_directory(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared folder. A local session that names none gets a
    temporary one, which goes when the process ends."""
    local = spark.conf.get("spark.master", "").startswith("local[")
    if spark.conf.get(workspace.SETTING, None) or not local:
        return workspace.fresh_directory(spark, name)
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="shelfcast-"))
        atexit.register(shutil.rmtree, _OWN_FOLDER[0], ignore_errors=True)
    return f"{_OWN_FOLDER[0]}/{name}-{uuid.uuid4().hex}"


def _stored_under(folder: str):
    def store_rows(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return store_rows


# Tables that several queries read: built from the given data once per session and directory.
_BUILT: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def _sales_zone(spark: SparkSession, sf_dir: str, grain: str = "TR") -> DataFrame:
    def build():
        path = fresh_directory(spark, "sales")
        sales = Retail(spark, sf_dir, grain).sales()
        zones.write_by_date(sales, path, mode="overwrite", padded=True)
        zones.record_dates(zones.read_zone(spark, path, SALES), f"{path}-manifest")
        return path

    return zones.read_zone(spark, _once(spark, sf_dir, f"sales {grain}", build), SALES)


def _feature_zone(spark: SparkSession, sf_dir: str, grain: str = "TR") -> DataFrame:
    def build():
        path = fresh_directory(spark, "features")
        zones.write_by_date(_features(Retail(spark, sf_dir, grain)), path, mode="overwrite")
        zones.record_dates(zones.read_zone(spark, path, FEATURES), f"{path}-manifest")
        return path

    return zones.read_zone(spark, _once(spark, sf_dir, f"features {grain}", build), FEATURES)


def _feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of grain TR as one stored table, for what reads all of them: a model does not
    ask for dates, and a folder for each costs more than its rows."""

    def build():
        path = fresh_directory(spark, "feature-rows")
        _features(Retail(spark, sf_dir, "TR")).write.parquet(path)
        return path

    path = _once(spark, sf_dir, "feature rows", build)
    return spark.read.schema(FEATURES).parquet(path)


def _manifest(spark: SparkSession, sf_dir: str, zone: str) -> DataFrame:
    (_sales_zone if zone == "sales" else _feature_zone)(spark, sf_dir)
    path = _BUILT[spark.sparkContext.applicationId, sf_dir, f"{zone} TR"]
    return zones.read_manifest(spark, f"{path}-manifest")


def _mean_pipeline():
    """A forest of one tree that is one leaf: it predicts the mean of what it is trained on."""
    return training.demand_pipeline(trees=1, bootstrap=False, maxDepth=0)


def _stored_model(spark: SparkSession, sf_dir: str, pipeline):
    path = fresh_directory(spark, "model")
    features = _feature_rows(spark, sf_dir)
    training.save_model(training.train_model(features, TRAINING_END, pipeline=pipeline), path)
    return path


def _model(spark: SparkSession, sf_dir: str):
    """The one-leaf model as stored and loaded again."""
    path = _once(
        spark, sf_dir, "model", lambda: _stored_model(spark, sf_dir, _mean_pipeline())
    )
    return training.load_model(path)


def _features(retail: Retail) -> DataFrame:
    return feature_plans.feature_table(
        retail.sales(), retail.catalog(), retail.stores(), retail.markdowns(), retail.discounts()
    )


def _plan_sides(retail: Retail) -> list[DataFrame]:
    return [
        retail.catalog(),
        retail.stores(),
        retail.markdowns(),
        retail.discounts(),
        retail.prices(),
    ]


# Sources and sinks


def scan_csv(spark, sf_dir):
    path = fresh_directory(spark, "csv")
    tables.write_csv(Retail(spark, sf_dir, "TR").sales(), path)
    return _out(tables.read_csv(spark, path, SALES))


def scan_csv_stray_index(spark, sf_dir):
    """A folder with an unnamed index column that no schema has."""
    path = fresh_directory(spark, "csv")
    sales = Retail(spark, sf_dir, "TR").sales()
    tables.write_csv(sales.withColumn("Unnamed: 0", F.monotonically_increasing_id()), path)
    return _out(tables.read_csv(spark, path, SALES, keep_rest=True))


def scan_csv_rejects(spark, sf_dir):
    """Some rows have a quantity, a date or a store that does not parse, some more than one."""
    path = fresh_directory(spark, "csv")
    whole = F.floor("sum_total")
    sales = Retail(spark, sf_dir, "TR").sales()
    text = sales.select(*[F.col(c).cast("string").alias(c) for c in SALES.names], whole.alias("_whole"))
    spoilt = text.withColumns(
        {
            "quantity": F.when(F.col("_whole") % 50 == 3, "many").otherwise(F.col("quantity")),
            "date": F.when(F.col("_whole") % 70 == 3, "2001-13-45").otherwise(F.col("date")),
            "store_id": F.when(F.col("_whole") % 90 == 3, "1.5").otherwise(F.col("store_id")),
        }
    )
    tables.write_csv(spoilt.drop("_whole"), path)
    parsed = rejects.parse_csv(spark, path, SALES)
    good = rejects.accepted(parsed, SALES).groupBy("store_id").agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("units")
    )
    bad = rejects.rejected(parsed, "sales", PROCESS_DATE)
    cells = bad.select(F.explode("problems").alias("p")).groupBy("p.column", "p.text", "p.reason")
    none = F.lit(None).cast("string")
    kinds = [
        good.select(F.lit("accepted").alias("kind"), F.col("store_id").cast("string").alias("text"),
                    none.alias("reason"), "n_rows", "units"),
        cells.agg(F.count("*").alias("n_rows")).select(
            F.col("column").alias("kind"), "text", "reason", "n_rows", F.lit(None).cast("double").alias("units")
        ),
        bad.agg(F.lit("rejected").alias("kind"), none.alias("text"), none.alias("reason"),
                F.count("*").alias("n_rows"), F.lit(None).cast("double").alias("units")),
    ]
    return reduce(DataFrame.unionByName, kinds)


def scan_csv_tables(spark, sf_dir):
    """The side tables from CSV: rows, keys, and a sum of what is measured."""
    retail = Retail(spark, sf_dir, "BN")
    found = _static_tables(retail) | {"actual_matrix": retail.sales().select("date", "item_id")}
    totals = {"markdowns": "normal_price", "discounts_history": "promo_type_code", "price_history": "price"}
    counts = []
    for name, df in found.items():
        path = fresh_directory(spark, name)
        tables.write_csv(df, path)
        back = tables.read_csv(spark, path, STATIC_TABLES[name])
        total = F.round(F.sum(totals[name]), 2) if name in totals else F.lit(0.0)
        counts.append(
            back.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("n_rows"),
                F.countDistinct("store_id" if name == "stores" else "item_id").alias("n_keys"),
                F.countDistinct(*back.columns).alias("n_distinct"),
                total.alias("total"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


def scan_one_date(spark, sf_dir):
    """One date's files opened without the zone around them."""
    _sales_zone(spark, sf_dir)
    path = _BUILT[spark.sparkContext.applicationId, sf_dir, "sales TR"]
    return _out(zones.read_date(spark, path, PROCESS_DATE, SALES))


def first_rows(spark, sf_dir):
    """A few rows to look at."""
    sales = Retail(spark, sf_dir, "BN").sales()
    order = [*KEYS, "sum_total", F.col("quantity").asc_nulls_first()]
    return _out(zones.first_rows(sales, order).select(*KEYS, "sum_total"))


def scan_partitioned(spark, sf_dir):
    columns = [*KEYS, "quantity", "price_base", "sum_total", "year", "month", "day"]
    return _out(_sales_zone(spark, sf_dir).select(*columns))


def scan_date_window(spark, sf_dir):
    window = zones.between_dates(
        _sales_zone(spark, sf_dir), shift(PROCESS_DATE, -365), PROCESS_DATE
    )
    return _out(window.select(*KEYS, "quantity", "sum_total"))


def partition_row_count(spark, sf_dir):
    return zones.partition_row_count(_sales_zone(spark, sf_dir), PROCESS_DATE)


def training_end_date(spark, sf_dir):
    return _out(zones.last_date(_manifest(spark, sf_dir, "sales")))


def next_dates(spark, sf_dir):
    return _out(zones.next_dates(_manifest(spark, sf_dir, "features")))


def write_features_roundtrip(spark, sf_dir):
    path = fresh_directory(spark, "features")
    zones.write_by_date(_features(Retail(spark, sf_dir, "TR")), path, mode="overwrite")
    written = zones.read_zone(spark, path, FEATURES).select(*FEATURE_COLUMNS)
    return _out(written, *_MEAN_PRICES)


def _per_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("units")
    )


def _land_history(spark, sf_dir, items):
    """The job over CSV files; the rows of each date of the two zones, and of the manifest."""
    raw, root = fresh_directory(spark, "raw"), fresh_directory(spark, "zones")
    tables.write_csv(Retail(spark, sf_dir, "BN").sales(), f"{raw}/sales.csv")
    jobs.land_history(spark, raw, root, items)
    parts = [
        _per_date(zones.read_zone(spark, f"{root}/{name}", SALES)).withColumn("part", F.lit(name))
        for name in ("sales", "recent")
    ]
    manifest = zones.read_manifest(spark, jobs.manifest_path(root, "sales"))
    recorded = manifest.select("date", F.col("n_rows").alias("n_recorded"))
    return _out(parts[0].unionByName(parts[1]).join(recorded, "date", "left"))


def ingest_history(spark, sf_dir):
    return _land_history(spark, sf_dir, None)


def ingest_history_of_items(spark, sf_dir):
    """The items come as a table."""
    return _land_history(spark, sf_dir, spark.createDataFrame([(i,) for i in ITEMS], "item_id string"))


def ingest_day(spark, sf_dir):
    """The zone holds all earlier dates; the day is landed twice, from CSV, and counts once."""
    path, arrivals = fresh_directory(spark, "landing"), f"{fresh_directory(spark, 'new')}/day.csv"
    sales = Retail(spark, sf_dir, "TR").sales()
    earlier = sales.where(F.col("date") < date_lit(PROCESS_DATE))
    zones.write_by_date(earlier, path, mode="overwrite", padded=True)
    tables.write_csv(sales.where(F.col("date") >= date_lit(PROCESS_DATE)), arrivals)
    for _ in range(2):
        jobs.land_day(tables.read_sales(spark, arrivals), path, PROCESS_DATE)
    return _out(_per_date(zones.read_zone(spark, path, SALES)))


def ingest_stream(spark, sf_dir):
    """Years of sales as files, landed by a stream in two runs. The second gets the last years, a
    copy of its files under other names, and rows that the first had left out of their dates. A
    file has whole dates, so many tasks write and a copy has file by file the same rows."""
    root, inbox = fresh_directory(spark, "stream"), fresh_directory(spark, "inbox")
    sales = Retail(spark, sf_dir, "BN").sales()
    late = (F.month("date") == 3) & (F.col("store_id") == 7)
    old = F.year("date") < 2000
    parts = [(old & ~late, "old"), (~old, "new"), (~old, "new again"), (old & late, "late")]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    for which, (rows, name) in enumerate(parts):
        files = sales.where(rows).select(*SALES.names).repartition(tasks, "date")
        tables.write_csv(files, f"{inbox}/{name}.csv")
        if which == 0:
            landing.land_stream(spark, f"{inbox}/*.csv", root, build=False).awaitTermination()
    landing.land_stream(spark, f"{inbox}/*.csv", root, build=False).awaitTermination()
    return _out(_per_date(zones.read_zone(spark, f"{root}/sales", SALES)))


def _static_tables(retail: Retail) -> dict[str, DataFrame]:
    return {
        "markdowns": retail.markdowns(),
        "discounts_history": retail.discounts(),
        "price_history": retail.prices(),
        "catalog": retail.catalog(),
        "stores": retail.stores(),
    }


def _table_counts(found: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.countDistinct("store_id" if name == "stores" else "item_id").alias("n_keys"),
        )
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest_static(spark, sf_dir):
    root = fresh_directory(spark, "static")
    found = _static_tables(Retail(spark, sf_dir, "BN"))
    tables.land_static(split.select_items_static(found, ITEMS), root)
    return _table_counts({name: tables.read_static(spark, root, name) for name in found})


def select_items_static(spark, sf_dir):
    found = _static_tables(Retail(spark, sf_dir, "BN"))
    return _table_counts(split.select_items_static(found, ITEMS))


def partition_manifest(spark, sf_dir):
    return _out(zones.partition_manifest(Retail(spark, sf_dir, "BN").sales()))


def publish_forecast(spark, sf_dir):
    """Parquet first, then the table from those files."""
    root = fresh_directory(spark, "forecasts")
    forecast = training.score(_model(spark, sf_dir), _inference(spark, sf_dir))
    written = spark.read.parquet(publish.publish_parquet(forecast, root, FORECAST_START))
    publish.publish_table(written, path=f"{root}-table")
    return _out(publish.forecast_summary(spark.table(publish.FORECAST_TABLE)))


def publish_versions(spark, sf_dir):
    """Three runs, each a version of its own; the name shows the last, the one before is kept."""
    root = fresh_directory(spark, "published")
    name = f"forecasts_{uuid.uuid4().hex}"
    forecast = training.score(_model(spark, sf_dir), _inference(spark, sf_dir))
    for more in (5, 3, 0):
        changed = forecast.withColumn("predicted_quantity", F.col("predicted_quantity") + more)
        publish.publish_version(changed, root, name, keep=2)
    kept = publish.published_versions(spark, root, name)
    before = spark.read.parquet(f"{root}/{name}/version={kept[0]}")
    parts = [
        publish.forecast_summary(df).withColumn("n_versions", F.lit(len(kept))).withColumn("shown", F.lit(shown))
        for df, shown in ((spark.table(name), True), (before, False))
    ]
    return _out(parts[0].unionByName(parts[1]))


# Filters, selections and null handling


def history_split(spark, sf_dir):
    parts = split.tag_recent(split.select_items(Retail(spark, sf_dir, "BN").sales(), ITEMS))
    return _out(
        parts.groupBy("part", "date", "item_id").agg(
            F.count("*").alias("n_rows"), F.round(F.sum("sum_total"), 2).alias("sum_total")
        )
    )


def history_split_counts(spark, sf_dir):
    history, recent = split.history_split(Retail(spark, sf_dir, "BN").sales(), ITEMS)
    parts = history.withColumn("is_history", F.lit(1)).unionByName(
        recent, allowMissingColumns=True
    )
    return parts.agg(
        F.count("is_history").alias("n_history"),
        (F.count("*") - F.count("is_history")).alias("n_recent"),
        F.count("*").alias("n_all"),
    )


def train_validation_split(spark, sf_dir):
    train, held_out = split.train_validation_split(_feature_zone(spark, sf_dir), TRAINING_END)
    parts = train.withColumn("part", F.lit("train")).unionByName(
        held_out.withColumn("part", F.lit("validate"))
    )
    return _out(
        parts.groupBy("part").agg(
            F.count("*").alias("n_rows"),
            F.sum(TARGET).alias("units"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )


def select_items(spark, sf_dir):
    sales = Retail(spark, sf_dir, "BN").sales()
    return _out(split.select_items(sales, ITEMS).select(*KEYS, "sum_total"))


def select_items_semi(spark, sf_dir):
    sales = Retail(spark, sf_dir, "PR").sales()
    rows = profile.select_items_semi(sales, profile.top_items(sales))
    return _out(rows.select(*KEYS, "sum_total"))


def drop_null_target(spark, sf_dir):
    sales = Retail(spark, sf_dir, "BN").sales()
    return _out(drop_missing_target(sales, "quantity").select(*KEYS, "quantity"))


def fill_numeric_query(spark, sf_dir):
    sales = Retail(spark, sf_dir, "BN").sales()
    return _out(fill_numeric(sales, ["quantity", "price_base", "sum_total"]).select(*SALES.names))


def fill_categorical(spark, sf_dir):
    """The promotion code is numeric: it is named in the fill and stays null."""
    retail = Retail(spark, sf_dir, "BN")
    demand = enrich.enrich_discounts(
        aggregates.daily_demand(retail.sales()).select(*KEYS, TARGET), retail.discounts()
    )
    described = enrich.enrich_dimensions(demand, retail.catalog(), retail.stores())
    filled = fill_categories(described, [*ATTRIBUTES, "promo_type_code", "absent_column"])
    return _out(filled.select(*KEYS, *ATTRIBUTES, "promo_type_code"))


def align_schema_union(spark, sf_dir):
    retail = Retail(spark, sf_dir, "TR")
    future = frame.forecast_frame(*_plan_sides(retail), FORECAST_START)
    combined = frame.align_schema_union(_features(retail), future)
    return _out(
        combined.select(
            *KEYS, TARGET, "avg_base_price", "promo_type_code", "lag_7_quantity", "dept_name"
        ),
        "avg_base_price",
    )


# Joins


def enrich_dimensions(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    demand = aggregates.daily_demand(retail.sales()).select(*KEYS, TARGET)
    joined = enrich.enrich_dimensions(demand, retail.catalog(), retail.stores())
    return _out(joined.select(*KEYS, TARGET, *ATTRIBUTES))


def enrich_dimensions_as_of(spark, sf_dir):
    """Items and stores land with changes from a date on; demand has what held on its date."""
    retail, root = Retail(spark, sf_dir, "BN"), fresh_directory(spark, "dimensions")
    catalog, stores = retail.catalog(), retail.stores()
    some = F.col("item_id").endswith("1")
    moved = F.when(some, F.concat(F.lit("moved "), "dept_name")).otherwise(F.col("dept_name"))
    for name, first, second in (
        ("catalog", catalog.where("item_id <> 'Brand#22'"), catalog.withColumn("dept_name", moved)),
        ("stores", stores, stores.where("store_id % 3 = 0").withColumn("city", F.lit("merged"))),
    ):
        tables.land_versions(first, root, name, "1990-01-01")
        tables.land_versions(second, root, name, "1998-02-01")
    again = catalog.where(some).withColumn("class_name", F.lit(None).cast("string"))
    tables.land_versions(again, root, "catalog", "2000-01-01")
    demand = aggregates.daily_demand(retail.sales()).select(*KEYS, TARGET)
    sides = (tables.read_versions(spark, root, name) for name in ("catalog", "stores"))
    return _out(enrich.enrich_dimensions(demand, *sides).select(*KEYS, TARGET, *ATTRIBUTES))


def enrich_markdowns(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    joined = enrich.enrich_markdowns(aggregates.daily_demand(retail.sales()), retail.markdowns())
    return _out(joined, "avg_base_price", "markdown_price", "markdown_normal_price")


def enrich_discounts(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    joined = enrich.enrich_discounts(aggregates.daily_demand(retail.sales()), retail.discounts())
    return _out(joined, "avg_base_price", *enrich.DISCOUNT_COLUMNS)


def demand_panel(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    panel = enrich.demand_panel(retail.sales(), retail.markdowns(), retail.discounts())
    return _out(panel, *_MEAN_PRICES)


def item_store_grid_query(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    return item_store_grid(retail.catalog(), retail.stores())


def date_spine(spark, sf_dir):
    series = Retail(spark, sf_dir, "BN").sales().select(*SERIES).distinct()
    return _out(frame.date_spine(series, FORECAST_START).select(*KEYS))


# Aggregations


def daily_demand(spark, sf_dir):
    return _out(aggregates.daily_demand(Retail(spark, sf_dir, "BN").sales()), "avg_base_price")


def daily_markdowns(spark, sf_dir):
    return _out(
        aggregates.daily_markdowns(Retail(spark, sf_dir, "BN").markdowns()),
        "markdown_price",
        "markdown_normal_price",
    )


def daily_discounts(spark, sf_dir):
    return _out(
        aggregates.daily_discounts(Retail(spark, sf_dir, "BN").discounts()),
        *enrich.DISCOUNT_COLUMNS,
    )


def stores_per_item(spark, sf_dir):
    return profile.stores_per_item(Retail(spark, sf_dir, "PR").sales())


def active_days_per_item(spark, sf_dir):
    return profile.active_days_per_item(Retail(spark, sf_dir, "PR").sales())


def rows_per_item(spark, sf_dir):
    return profile.rows_per_item(Retail(spark, sf_dir, "PR").sales())


def mean_quantity_per_item(spark, sf_dir):
    return profile.mean_quantity_per_item(Retail(spark, sf_dir, "PR").sales())


def sales_date_range(spark, sf_dir):
    return _out(profile.sales_date_range(Retail(spark, sf_dir, "BN").sales()))


def items_in_all_stores(spark, sf_dir):
    return profile.items_in_all_stores(Retail(spark, sf_dir, "PR").sales())


def top_items(spark, sf_dir):
    return profile.top_items(Retail(spark, sf_dir, "PR").sales())


def assortment_profile(spark, sf_dir):
    return profile.assortment_profile(Retail(spark, sf_dir, "PR").sales())


def assortment_profile_by_day(spark, sf_dir):
    """From stored summaries of each date; one date is summarised a second time, from other
    sales first."""
    sales = Retail(spark, sf_dir, "PR").sales()
    path = fresh_directory(spark, "summaries")
    day = F.col("date") == date_lit("2001-05-03")
    halves = [sales.where(~day), sales.where(day & (F.col("store_id") == 1)), sales.where(day)]
    for n, rows in enumerate(halves):
        stored = summaries.day_summaries(rows).withColumn("n", F.lit(int(n > 0)))
        stored.write.partitionBy("n").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return summaries.profile_of_summaries(spark.read.schema(summaries.SUMMARY).parquet(path))


def assortment_attribute_counts(spark, sf_dir):
    retail = Retail(spark, sf_dir, "BN")
    return profile.assortment_attribute_counts(
        retail.catalog(), profile.top_items(retail.sales())
    )


def dummies(spark, sf_dir):
    sales = Retail(spark, sf_dir, "TR").sales().select(*KEYS, "sum_total")
    return _out(profile.dummies(sales, "item_id", TYPES))


def dummy_entries(spark, sf_dir):
    sales = Retail(spark, sf_dir, "PR").sales().select(*KEYS, "sum_total")
    return _out(profile.dummy_entries(sales, "item_id"))


def rmse(spark, sf_dir):
    """How far off the quantity a week of rows before is."""
    demand = aggregates.daily_demand(Retail(spark, sf_dir, "TR").sales()).select(*KEYS, TARGET)
    lagged = fill_numeric(demand.withColumns(lag_columns(lags=(7,))), ["lag_7_quantity"])
    return aggregates.rmse(lagged, TARGET, "lag_7_quantity")


# Windows


def lag_features(spark, sf_dir):
    demand = aggregates.daily_demand(Retail(spark, sf_dir, "TR").sales()).select(*KEYS, TARGET)
    return _out(demand.withColumns(lag_columns()))


def rolling_features(spark, sf_dir):
    demand = aggregates.daily_demand(Retail(spark, sf_dir, "TR").sales()).select(*KEYS, TARGET)
    return _out(demand.withColumns(rolling_mean_columns()))


# Scalar functions


def calendar_features(spark, sf_dir):
    """Dates are read back from text first."""
    sales = Retail(spark, sf_dir, "BN").sales()
    keys = sales.select(*KEYS).distinct()
    text = F.date_format("date", "yyyy-MM-dd")
    return _out(keys.withColumn("date", parse_date(text)).withColumns(calendar_columns()))


def partition_keys(spark, sf_dir):
    dates = Retail(spark, sf_dir, "BN").sales().select("date").distinct()
    padded = {f"{k}_padded": v for k, v in date_parts(padded=True).items()}
    return _out(
        dates.withColumns(
            {
                **date_parts(),
                **padded,
                "path": partition_path(),
                "unpadded_path": partition_path(padded=False),
            }
        )
    )


def promotion_flag_query(spark, sf_dir):
    retail = Retail(spark, sf_dir, "TR")
    panel = enrich.demand_panel(retail.sales(), retail.markdowns(), retail.discounts())
    return _out(panel.select(*KEYS, promotion_flag().alias("on_promotion")))


def clamp_forecast(spark, sf_dir):
    """Stand-in predictions of both signs: the change from the row a week before, scaled."""
    demand = aggregates.daily_demand(Retail(spark, sf_dir, "TR").sales())
    lagged = fill_numeric(demand.withColumns(lag_columns()), ["lag_7_quantity"])
    prediction = (F.col(TARGET) - F.col("lag_7_quantity")) * F.lit(0.3)
    return _out(lagged.select(*KEYS, whole_units(prediction).alias("predicted_quantity")))


# Feature and forecast plans


def feature_table(spark, sf_dir):
    return _out(_features(Retail(spark, sf_dir, "TR")), *_MEAN_PRICES)


def feature_table_fine_grain(spark, sf_dir):
    return _out(_features(Retail(spark, sf_dir, "BN")), *_MEAN_PRICES)


def empty_feature_table(spark, sf_dir):
    """No sales, for none are that old."""
    retail = Retail(spark, sf_dir, "TR")
    none = zones.between_dates(retail.sales(), last="1990-01-01")
    sides = retail.catalog(), retail.stores(), retail.markdowns(), retail.discounts()
    return _out(feature_plans.feature_table(none, *sides), *_MEAN_PRICES)


def _one_day(spark, sf_dir, grain: str, history: DataFrame | None) -> DataFrame:
    retail = Retail(spark, sf_dir, grain)
    rows = feature_plans.feature_table_for_day(
        _sales_zone(spark, sf_dir, grain),
        retail.catalog(),
        retail.stores(),
        retail.markdowns(),
        retail.discounts(),
        PROCESS_DATE,
        history=history,
    )
    return _out(rows, *_MEAN_PRICES)


def feature_table_incremental(spark, sf_dir):
    """The past from the feature zone."""
    return _one_day(spark, sf_dir, "TR", _feature_zone(spark, sf_dir))


def feature_table_incremental_daily(spark, sf_dir):
    """The same where each series has sales on all dates of the look-back."""
    return _one_day(spark, sf_dir, "DY", _feature_zone(spark, sf_dir, "DY"))


# A date with other quantities, one without a store, one that was not there at all.
CORRECTED = ["2001-05-03", "2001-05-20", "2001-06-02"]


def feature_table_corrected(spark, sf_dir):
    """Features made from wrong sales of three past dates, then corrected from the sales as they
    are: the rows of the dates that are touched, and the others as they were."""
    root, retail = fresh_directory(spark, "corrected"), Retail(spark, sf_dir, "TR")
    sales = retail.sales()
    sides = retail.catalog(), retail.stores(), retail.markdowns(), retail.discounts()
    more, fewer, absent = (F.col("date") == date_lit(d) for d in CORRECTED)
    wrong = sales.where(~absent & ~(fewer & (F.col("store_id") == 2)))
    wrong = wrong.withColumn("quantity", F.col("quantity") + F.when(more, 40.0).otherwise(0.0))
    store_rows = _stored_under(root)
    history = store_rows(feature_plans.feature_table(wrong, *sides), "features")
    dates = [as_date(d) for d in CORRECTED]
    rows, touched = corrections.corrected_features(history, sales, *sides, dates, store_rows)
    untouched = zones.on_dates(history, touched, keep=False)
    return _out(rows.unionByName(untouched.select(*FEATURE_COLUMNS)), *_MEAN_PRICES)


def feature_table_incremental_from_sales(spark, sf_dir):
    return _one_day(spark, sf_dir, "TR", None)


_FRAME_COLUMNS = [*KEYS, *PRICE_COLUMNS, "promo_type_code", *ATTRIBUTES]


def forecast_frame(spark, sf_dir):
    rows = frame.forecast_frame(*_plan_sides(Retail(spark, sf_dir, "TR")), FORECAST_START)
    return _out(rows.select(*_FRAME_COLUMNS), *_MEAN_PRICES)


def forecast_frame_raw(spark, sf_dir):
    sides = _plan_sides(Retail(spark, sf_dir, "TR"))
    rows = frame.forecast_frame(*sides, FORECAST_START, plan="raw")
    return _out(rows.select(*_FRAME_COLUMNS), *_MEAN_PRICES)


def _inference(spark, sf_dir, grain: str = "TR", plan: str = "aggregate") -> DataFrame:
    sides = _plan_sides(Retail(spark, sf_dir, grain))
    history = _feature_rows(spark, sf_dir)
    if grain != "TR":
        history = _feature_zone(spark, sf_dir, grain)
    return frame.inference_features(history, *sides, FORECAST_START, plan=plan)


def inference_features(spark, sf_dir):
    return _out(_inference(spark, sf_dir).drop(TARGET), *_MEAN_PRICES)


def inference_features_daily(spark, sf_dir):
    """Two series with a sale on every date of the look-back, so that the yearly lag is seen."""
    return _out(_inference(spark, sf_dir, "DY").drop(TARGET), *_MEAN_PRICES)


def inference_recursive(spark, sf_dir):
    """Nine days, each seeing the forecasts of those before it: the lag of seven too."""
    found = recursive.recursive_forecast(
        _model(spark, sf_dir),
        _feature_rows(spark, sf_dir),
        *_plan_sides(Retail(spark, sf_dir, "TR")),
        FORECAST_START,
        _stored_under(fresh_directory(spark, "recursive")),
        days=9,
    )
    return _out(found.drop(TARGET), *_MEAN_PRICES)


def inference_features_raw(spark, sf_dir):
    """A row for each planned row, over the pairs of a coarse item and a store."""
    return _out(_inference(spark, sf_dir, "TR", "raw").drop(TARGET), *_MEAN_PRICES)


# Model


def category_index(spark, sf_dir):
    features = _feature_rows(spark, sf_dir).select(*CATEGORY_INPUTS)
    indexed = training.category_indexer().fit(features).transform(features)
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(c).alias("value"),
                    F.col(f"{c}_indexed").alias("position"),
                )
                for c in CATEGORY_INPUTS
            ]
        )
    )
    return indexed.select(pairs.alias("pair")).select("pair.*").distinct()


def category_labels(spark, sf_dir):
    """Items by frequency as a table: no label passes the driver."""
    store_rows = _stored_under(fresh_directory(spark, "labels"))
    sales = Retail(spark, sf_dir, "PR").sales()
    return labels.label_table(sales, ["item_id", "store_id"], store_rows)


def backtest_query(spark, sf_dir):
    """Three cuts a fortnight apart, with the forest of one leaf."""
    ends = backtest.rolling_ends(TRAINING_END, 3)
    errors = backtest.backtest(_feature_rows(spark, sf_dir), ends, pipeline=_mean_pipeline())
    return errors.select("fold", "ahead", "n_rows", *[F.round(c, 6).alias(c) for c in ("rmse", "mean_error")])


def category_onehot(spark, sf_dir):
    """Rows per slot of each encoded column: the sum of its vectors over the whole table."""
    features = _feature_rows(spark, sf_dir).select(*CATEGORY_INPUTS)
    indexed = training.category_indexer().fit(features).transform(features)
    encoded = training.category_encoder().fit(indexed).transform(indexed)
    sums = encoded.select(
        *[Summarizer.sum(F.col(f"{c}_encoded")).alias(c) for c in CATEGORY_INPUTS]
    )
    columns = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), vector_to_array(c).alias("counts"))
            for c in CATEGORY_INPUTS
        ]
    )
    listed = sums.select(F.explode(columns).alias("listed")).select("listed.*")
    return listed.select("column_name", F.posexplode("counts").alias("slot", "n_rows"))


def assemble_features(spark, sf_dir):
    """The assembled vector taken apart again: its numeric slots by name, its length, and how
    many category slots are set."""
    features = _feature_rows(spark, sf_dir)
    indexed = training.category_indexer().fit(features).transform(features)
    encoded = training.category_encoder().fit(indexed).transform(indexed)
    numbered = {c: i for i, c in enumerate(NUMERIC_INPUTS)}
    rows = (
        training.feature_assembler()
        .transform(encoded)
        .select("date", "item_id", vector_to_array("features").alias("v"))
    )
    categories = F.slice("v", len(numbered) + 1, F.size("v") - len(numbered))
    return _out(
        rows.select(
            "date",
            "item_id",
            *[F.col("v")[i].alias(c) for c, i in numbered.items()],
            F.size("v").alias("n_slots"),
            F.aggregate(categories, F.lit(0.0), lambda a, b: a + b).alias("n_set"),
        ),
        *_MEAN_PRICES,
    )


def train_model(spark, sf_dir):
    """Hold-out predictions of the stored model."""
    predictions = training.validation_predictions(
        _model(spark, sf_dir), _feature_rows(spark, sf_dir), TRAINING_END
    )
    return _out(predictions.select(*KEYS, TARGET, "prediction"))


def validation_rmse(spark, sf_dir):
    predictions = training.validation_predictions(
        _model(spark, sf_dir), _feature_rows(spark, sf_dir), TRAINING_END
    )
    error = aggregates.rmse(predictions, TARGET, "prediction")
    return error.select(F.round("rmse", 6).alias("rmse"))


def train_forest(spark, sf_dir):
    """The forest of full size, stored and loaded: each held-out row with what must hold for it."""
    features = _feature_rows(spark, sf_dir)
    fitted = training.train_model(features, TRAINING_END)
    path = fresh_directory(spark, "forest")
    training.save_model(fitted, path)
    loaded = training.load_model(path)
    before = training.validation_predictions(fitted, features, TRAINING_END)
    after = training.validation_predictions(loaded, features, TRAINING_END)
    formula = aggregates.rmse(after, TARGET, "prediction").first()[0]
    both = before.select(*KEYS, TARGET, F.col("prediction").alias("fitted")).join(
        after.select(*KEYS, "prediction"), KEYS
    )
    close = abs(training.validation_rmse(after) - formula) < 1e-9 * formula
    return _out(
        both.select(
            *KEYS,
            TARGET,
            F.lit(loaded.stages[-1].getNumTrees).alias("n_trees"),
            (F.col("fitted") == F.col("prediction")).alias("loads_the_same"),
            (F.col("prediction") >= 0).alias("not_negative"),
            F.lit(close).alias("evaluator_agrees"),
        )
    )


def training_guard(spark, sf_dir):
    """Without rows before the hold-out nothing is trained."""
    features = _feature_rows(spark, sf_dir)
    model = training.train_model(features, "1990-01-01", pipeline=_mean_pipeline())
    return features.agg(F.count("*").alias("n_rows"), F.lit(model is None).alias("untrained"))


def score_forecast(spark, sf_dir):
    return _out(training.score(_model(spark, sf_dir), _inference(spark, sf_dir)))


QUERIES = {
    f.__name__.removesuffix("_query"): f
    for f in (
        feature_table,
        feature_table_fine_grain,
        feature_table_incremental,
        feature_table_incremental_from_sales,
        feature_table_incremental_daily,
        feature_table_corrected,
        empty_feature_table,
        scan_csv,
        scan_csv_stray_index,
        scan_csv_rejects,
        scan_csv_tables,
        scan_one_date,
        first_rows,
        scan_partitioned,
        scan_date_window,
        partition_row_count,
        training_end_date,
        next_dates,
        write_features_roundtrip,
        ingest_history,
        ingest_history_of_items,
        ingest_day,
        ingest_stream,
        ingest_static,
        select_items_static,
        partition_manifest,
        history_split,
        history_split_counts,
        train_validation_split,
        select_items,
        select_items_semi,
        drop_null_target,
        fill_numeric_query,
        fill_categorical,
        align_schema_union,
        enrich_dimensions,
        enrich_dimensions_as_of,
        enrich_markdowns,
        enrich_discounts,
        demand_panel,
        item_store_grid_query,
        date_spine,
        daily_demand,
        daily_markdowns,
        daily_discounts,
        stores_per_item,
        active_days_per_item,
        rows_per_item,
        mean_quantity_per_item,
        sales_date_range,
        items_in_all_stores,
        top_items,
        assortment_profile,
        assortment_profile_by_day,
        assortment_attribute_counts,
        dummies,
        dummy_entries,
        rmse,
        lag_features,
        rolling_features,
        calendar_features,
        partition_keys,
        promotion_flag_query,
        clamp_forecast,
        forecast_frame,
        forecast_frame_raw,
        inference_features,
        inference_features_daily,
        inference_features_raw,
        inference_recursive,
        category_index,
        category_labels,
        category_onehot,
        assemble_features,
        train_model,
        validation_rmse,
        train_forest,
        training_guard,
        backtest_query,
        score_forecast,
        publish_forecast,
        publish_versions,
    )
}
