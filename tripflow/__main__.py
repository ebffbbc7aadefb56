"""Command line: run the monthly job or show its reports.

    python -m tripflow month --zones zones.csv --root out trips_2026-01.parquet ...
    python -m tripflow dashboard --root out --hour 18 --airport JFK

Both also work through ``spark-submit``, which supplies master and options.
"""

from __future__ import annotations

import argparse

from tripflow.plans.dashboard import dashboard
from tripflow.plans.jobs import run_month
from tripflow.session import build_session, listed_bytes, sizing


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripflow")
    commands = parser.add_subparsers(dest="command", required=True)
    month = commands.add_parser("month", help="land, clean, enrich, answer, export, serve")
    month.add_argument("sources", nargs="+", help="monthly source files")
    month.add_argument("--zones", required=True, help="zone table as CSV")
    month.add_argument("--root", required=True, help="output folder")
    month.add_argument("--schema", default="trip_analytics")
    month.add_argument("--min-trips", type=int, default=20)
    month.add_argument("--input-gb", type=float, help="size of the sources; read from the listing by default")
    month.add_argument("--text", action="store_true", help="sources are headerless delimited text")
    month.add_argument("--cores", type=int, default=8, help="cores of the cluster")
    shown = commands.add_parser("dashboard", help="show the report frames")
    shown.add_argument("--root", required=True, help="output folder of the month command")
    shown.add_argument("--hour", type=int, default=18, choices=range(24), metavar="0-23")
    shown.add_argument("--airport", default="JFK", choices=["JFK", "LGA", "EWR"])
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = _arguments(given)
    if args.command == "month":
        spark = build_session()
        size = listed_bytes(spark, args.sources) if args.input_gb is None else int(args.input_gb * 1e9)
        for option, value in sizing(size, args.cores).items():
            spark.conf.set(option, value)
        counted = run_month(
            spark, args.sources, args.zones, args.root, args.schema,
            min_trips=args.min_trips, text=args.text,
        )
        print(f"kept {counted['clean_rows']} of {counted['raw_rows']} trips")
    else:
        spark = build_session()
        for panel, frame in dashboard(spark, args.root, args.hour, args.airport).items():
            print(panel)
            frame.show(50, truncate=False)


if __name__ == "__main__":
    main()
