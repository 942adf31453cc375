"""``spark-submit shelfcast/__main__.py <job> ...`` or ``python -m shelfcast <job> ...``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfcast.plans import jobs
from shelfcast.plans.frame import PLANS
from shelfcast.schemas import HORIZON_DAYS, SALES
from shelfcast.sources.publish import FORECAST_TABLE
from shelfcast.streaming.landing import land_stream
from shelfcast.sources.zones import WRITE_MODES, next_dates, read_manifest, read_zone


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shelfcast")
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="zone root")
        return sub

    def rejects(sub: argparse.ArgumentParser) -> None:
        text = "share of rows that may fail to parse; they go to the reject zone"
        sub.add_argument("--max-rejected", type=float, default=0.0, help=text)

    def arrivals(sub: argparse.ArgumentParser) -> None:
        text = "new sales, CSV or Parquet; by default the recent dates held back"
        sub.add_argument("--arrivals", help=text)
        rejects(sub)

    def publishing(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--plan", choices=PLANS, default=PLANS[0])
        text = "score day by day, each seeing the forecasts of the days before it"
        sub.add_argument("--feed-back", action="store_true", help=text)
        sub.add_argument("--table", help="catalog table to replace")
        sub.add_argument("--jdbc-url")
        sub.add_argument("--jdbc-table", default=FORECAST_TABLE)
        sub.add_argument("--jdbc-user")
        sub.add_argument("--jdbc-password-env", help="environment variable with the password")
        sub.add_argument("--jdbc-driver", help="class of the driver")
        sub.add_argument("--jdbc-batch", type=int, default=10_000)

    sub = command("land-history", "split the raw CSVs and land them")
    sub.add_argument("--raw", required=True, help="folder with the raw CSVs")
    chosen = sub.add_mutually_exclusive_group()
    chosen.add_argument("--items", nargs="+", help="only these items; all by default")
    chosen.add_argument("--items-file", help="text with an item id on each line")
    rejects(sub)

    sub = command("land-day", "land one date of the arrivals")
    arrivals(sub)
    sub.add_argument("--ingestion-date", required=True)

    sub = command("features", "build the feature table, or one date of it")
    sub.add_argument("--process-date")
    sub.add_argument("--mode", choices=WRITE_MODES)

    command("correct", "bring past days that were landed again into the features")

    sub = command("land-static", "land side tables by themselves")
    sub.add_argument("--raw", required=True, help="folder with the CSVs that are new")
    sub.add_argument("--holds-from", help="first date of changed items and stores; today by default")

    sub = command("land-stream", "land the files of a folder that were not landed yet")
    sub.add_argument("--arrivals", required=True, help="folder that sales files come to")

    sub = command("train", "fit, validate and store the model")
    sub.add_argument("--model", required=True)
    sub.add_argument("--training-end-date")
    sub.add_argument("--without", nargs="+", default=[], help="categories that are no inputs")
    sub.add_argument("--folds", type=int, default=0, help="earlier cuts to validate at as well")

    sub = command("forecast", "forecast the days from a start date")
    sub.add_argument("--model", required=True)
    sub.add_argument("--forecast-date", required=True)
    sub.add_argument("--days", type=int, default=HORIZON_DAYS)
    publishing(sub)

    sub = command("daily", "land the next date, build its features, forecast")
    sub.add_argument("--model", required=True)
    sub.add_argument("--process-date")
    arrivals(sub)
    publishing(sub)

    command("profile", "bring the assortment profile up to date and show it")
    command("compact", "rewrite the dates that have too many files")
    command("next-dates", "print the next process and forecast dates")
    return top


def _publishing(args: argparse.Namespace) -> dict:
    """The arguments of ``jobs.forecast`` that say where forecasts go."""
    found = {"plan": args.plan, "table": args.table, "feed_back": args.feed_back}
    if args.jdbc_url:
        found |= {"jdbc_url": args.jdbc_url, "jdbc_table": args.jdbc_table, "batch": args.jdbc_batch}
        for name, value in (
            ("user", args.jdbc_user),
            ("password", os.environ[args.jdbc_password_env] if args.jdbc_password_env else None),
            ("driver", args.jdbc_driver),
        ):
            if value is not None:
                found[name] = value
    return found


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "land-history":
        items = args.items
        if args.items_file:
            items = spark.read.text(args.items_file).select(F.trim("value").alias("item_id"))
        jobs.land_history(spark, args.raw, args.root, items, args.max_rejected)
        return
    if args.job == "land-stream":
        land_stream(spark, args.arrivals, args.root).awaitTermination()
        return
    arrivals = None
    if getattr(args, "arrivals", None):
        arrivals = jobs.arrivals_of(spark, args.arrivals, args.root, max_rejected=args.max_rejected)
    if args.job == "land-day":
        if arrivals is None:
            arrivals = read_zone(spark, f"{args.root}/recent", SALES)
        manifest = jobs.manifest_path(args.root, "sales")
        n_rows = jobs.land_day(arrivals, f"{args.root}/sales", args.ingestion_date, manifest)
        print(f"{args.ingestion_date}: {n_rows} rows")
    elif args.job == "features":
        jobs.build_features(spark, args.root, args.process_date, args.mode)
    elif args.job == "profile":
        jobs.refresh_profile(spark, args.root).show()
    elif args.job == "compact":
        print(f"{jobs.compact_zones(spark, args.root)} dates rewritten")
    elif args.job == "correct":
        print(f"{len(jobs.correct_features(spark, args.root))} dates rewritten")
    elif args.job == "land-static":
        landed = jobs.land_side_tables(spark, args.raw, args.root, holds_from=args.holds_from)
        print(f"landed: {', '.join(landed) or 'nothing'}")
    elif args.job == "train":
        error = jobs.train(
            spark, args.root, args.model, args.training_end_date, args.without, args.folds
        )
        print("no training rows" if error is None else f"validation RMSE: {error:.2f}")
    elif args.job == "forecast":
        jobs.forecast(
            spark, args.root, args.model, args.forecast_date, args.days, **_publishing(args)
        )
    elif args.job == "daily":
        jobs.run_daily(
            spark, args.root, args.model, args.process_date, arrivals, **_publishing(args)
        )
    else:
        next_dates(read_manifest(spark, jobs.manifest_path(args.root, "features"))).show()


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"shelfcast-{args.job}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
