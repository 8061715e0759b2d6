"""Jobs for spark-submit: extract, load (as files arrive) and daily."""

from __future__ import annotations

import argparse

from watchlytics import schemas
from watchlytics.plans.daily import run_daily
from watchlytics.plans.extract import run_extract
from watchlytics.plans.models import Parameters
from watchlytics.session import build_session
from watchlytics.streaming.incremental import land_incremental


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="watchlytics", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    extract = jobs.add_parser("extract")
    extract.add_argument("--source-format", default="jdbc")
    extract.add_argument("--source-root", help="folder of the tables, for file sources")
    extract.add_argument("--option", action="append", default=[], help="connection option name=value")
    extract.add_argument("--partitions", type=int, default=64)

    load = jobs.add_parser("load")
    load.add_argument("--table", choices=list(schemas.TABLES), required=True)
    load.add_argument("--out", required=True)
    load.add_argument("--checkpoint", required=True)
    load.add_argument("--rejects", help="folder of the lines that do not fit")

    daily = jobs.add_parser("daily")
    daily.add_argument("--store", required=True)
    daily.add_argument("--start-date", default=schemas.START_DATE)
    daily.add_argument("--active-days", type=int, default=schemas.ACTIVE_DAYS)
    daily.add_argument("--premium-plan", action="append", help="may be given more than once")

    for job in (extract, load, daily):
        job.add_argument("--landing", required=True)
    for job in (extract, daily):
        job.add_argument("--as-of", required=True, help="day of the run, yyyy-mm-dd")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"watchlytics-{args.job}")
    if args.job == "extract":
        source = {
            "format": args.source_format,
            "root": args.source_root,
            "options": dict(option.split("=", 1) for option in args.option),
        }
        run_extract(spark, source, args.landing, args.as_of, args.partitions).show(truncate=False)
    elif args.job == "load":
        stream = land_incremental(spark, args.landing, args.table, args.out, args.checkpoint, rejects=args.rejects)
        stream.awaitTermination()
    else:
        parameters = Parameters(
            as_of=args.as_of,
            start_date=args.start_date,
            active_days=args.active_days,
            premium_plans=args.premium_plan or list(schemas.PREMIUM_PLANS),
        )
        run_daily(spark, args.landing, args.store, parameters).show(200, truncate=False)


if __name__ == "__main__":
    main()
