"""Command line: ``python -m stellate load|refresh|export|profile ...``.

``load`` reads the source files (arrivals Parquet folder ``sas_data``, the
demographics and temperature CSVs, the three lookup CSVs), builds and writes
the star schema and its quality report.  ``refresh`` adds a delivery of
arrivals to the published tables.  ``export`` writes the published tables as
plain folders.  ``profile`` writes the arrivals
null-count and summary profiles as CSV.  Spark settings come from
``spark-submit`` / ``spark-defaults.conf`` as usual.
"""

from __future__ import annotations

import argparse
import sys

from stellate.plans.pipeline import profile_arrivals, run_load, sources_from_files
from stellate.plans.refresh import refresh_arrivals
from stellate.session import get_session, input_bytes, size_session
from stellate.sinks.snapshots import export_tables
from stellate.sources.files import read_arrivals


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stellate")
    sub = p.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="build, write and check the star schema")
    load.add_argument("--input", required=True, help="folder with sas_data/ and the CSV files")
    load.add_argument("--output", required=True, help="output folder (any Hadoop path)")
    load.add_argument("--temperatures", help="temperature CSV, if not in the input folder")
    load.add_argument("--on-fail", choices=("report", "raise"), default="report")
    load.add_argument("--null-key-threshold", type=int, default=0)
    load.add_argument("--calendar-null-dates", choices=("raise", "drop"), default="raise")
    load.add_argument("--strict", action="store_true", help="fail on a malformed number or date")
    load.add_argument("--raw-lookups", action="store_true", help="keep lookup labels as read")
    load.add_argument("--quarantine", action="store_true", help="put rows with a null key aside, with the reason")
    fresh = sub.add_parser("refresh", help="add a delivery of arrivals to the published tables")
    fresh.add_argument("--input", required=True, help="arrivals Parquet folder")
    fresh.add_argument("--output", required=True)
    export = sub.add_parser("export", help="write the published tables as plain folders")
    export.add_argument("--input", required=True, help="output folder of a load")
    export.add_argument("--output", required=True)
    prof = sub.add_parser("profile", help="null counts and summary of the arrivals")
    prof.add_argument("--input", required=True, help="arrivals Parquet folder")
    prof.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session("stellate")
    size_session(spark, input_bytes(spark, args.input, *filter(None, [getattr(args, "temperatures", None)])))
    if args.command == "load":
        src = sources_from_files(spark, args.input, temperatures_path=args.temperatures,
                                 clean_lookups=not args.raw_lookups, strict=args.strict)
        report = run_load(spark, src, args.output, on_fail=args.on_fail,
                          null_key_threshold=args.null_key_threshold,
                          calendar_null_dates=args.calendar_null_dates,
                          strict_dates=args.strict, quarantine=args.quarantine)
        report.show(truncate=False)
    elif args.command == "refresh":
        refresh_arrivals(spark, read_arrivals(spark, args.input, check=True), args.output).show(truncate=False)
    elif args.command == "export":
        export_tables(spark, args.input, args.output)
    else:
        profile_arrivals(read_arrivals(spark, args.input), args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
