"""Command line for the jobs: ``python -m signalgrid <job> --lake <root> ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from signalgrid.operators import forecast
from signalgrid.plans import jobs
from signalgrid.settings import tune


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="signalgrid")
    top.add_argument("--lake", required=True, help="folder of all tables")
    steps = top.add_subparsers(dest="job", required=True)
    for name in ("ingest", "quality", "facts"):
        step = steps.add_parser(name)
        step.add_argument("--date", required=True, help="YYYY-MM-DD")
        step.add_argument("--hour", required=True, type=int)
        if name == "ingest":
            step.add_argument("--input", help="landing file; default by date and hour")
    steps.add_parser("cells").add_argument("--input", required=True)
    steps.add_parser("late")
    steps.add_parser("dimensions")
    model = steps.add_parser("forecast")
    model.add_argument("--date", required=True)
    model.add_argument("--lookback-days", type=int, default=forecast.LOOKBACK_DAYS)
    model.add_argument("--model", choices=("seasonal", "fourier", "changepoints"), default="seasonal")
    steps.add_parser("evaluate").add_argument("--date", required=True)
    steps.add_parser("register").add_argument("--replace", action="store_true")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = jobs.Lake(args.lake)
    match args.job:
        case "ingest":
            jobs.ingest_measurements(spark, lake, args.date, args.hour, args.input)
        case "quality":
            jobs.check_quality(spark, lake, args.date, args.hour)
        case "facts":
            jobs.build_facts(spark, lake, args.date, args.hour)
        case "cells":
            jobs.ingest_cells(spark, lake, args.input)
        case "late":
            jobs.merge_late(spark, lake)
        case "dimensions":
            jobs.build_date_dim(spark, lake)
            jobs.build_hex_dim(spark, lake)
        case "forecast":
            model = getattr(forecast, args.model)
            jobs.run_forecast(spark, lake, args.date, args.lookback_days, model)
        case "evaluate":
            jobs.evaluate_day(spark, lake, args.date)
        case "register":
            jobs.register_tables(spark, lake, replace=args.replace)


def main() -> None:
    args = parser().parse_args()
    spark = tune(SparkSession.builder.appName(f"signalgrid-{args.job}").getOrCreate())
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
