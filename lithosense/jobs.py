"""Command line: ``python -m lithosense.jobs rollup --level 15min --kind temperature ...``."""

from __future__ import annotations

import argparse

from lithosense.constants import LEVELS
from lithosense.operators import ingest
from lithosense.plans import cascade as C
from lithosense.plans.incremental import update_level
from lithosense.plans.section_table import build_section_table
from lithosense.session import build_session
from lithosense.sources import readers, sinks


def rollup(spark, args) -> None:
    rules = C.rules_for(args.kind)
    todo = LEVELS if args.level == "all" else (args.level,)
    for level in todo:
        finer = None
        if level == "15min":
            if args.kind == "weather":
                # One CSV file or a whole folder of them.
                raw = readers.scan_weather(spark, args.input) if args.input.endswith(".csv") else readers.scan_weather_dir(spark, args.input)
                wide = ingest.metric_select(raw)
                finer = ingest.to_long(wide)
            elif args.meta:
                samples, meta = readers.scan_channels(spark, args.input, args.meta)
                finer = ingest.readings_from_channels(samples, meta)
            else:
                fmt = "csv" if args.input.endswith(".csv") else "parquet"
                wide = readers.scan_readings_wide(spark, args.input, fmt, args.start)
                temp, _ = ingest.identify_series(wide.columns)
                finer = ingest.to_long(ingest.coerce_numeric(wide, temp), temp)
        update_level(spark, args.output, level, rules, finer, args.as_of, args.late_days, args.full)


def section_table(spark, args) -> None:
    tables = readers.scan_section_tables(spark, args.input, args.format)
    sinks.export_table(build_section_table(tables), args.output, args.format)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lithosense")
    sub = parser.add_subparsers(dest="job", required=True)
    r = sub.add_parser("rollup", help="compute and store one level (or all)")
    r.add_argument("--level", choices=(*LEVELS, "all"), default="all")
    r.add_argument("--kind", choices=("temperature", "weather"), default="temperature")
    r.add_argument("--in", dest="input", default="")
    r.add_argument("--meta", help="channel facts, when the input is decoded channels")
    r.add_argument("--start", help="start instant for exports with a seconds column only")
    r.add_argument("--out", dest="output", required=True)
    r.add_argument("--as-of", help="only buckets closed at this instant")
    r.add_argument("--late-days", type=int, default=1, help="days before the last mark whose coarser levels are computed again in any case")
    r.add_argument("--full", action="store_true", help="compute all days, not only those since the last mark")
    s = sub.add_parser("section-table", help="build the modelling table")
    s.add_argument("--in", dest="input", required=True)
    s.add_argument("--out", dest="output", required=True)
    s.add_argument("--format", choices=("csv", "parquet"), default="parquet")
    args = parser.parse_args(argv)
    spark = build_session(f"lithosense-{args.job}")
    {"rollup": rollup, "section-table": section_table}[args.job](spark, args)


if __name__ == "__main__":
    main()
