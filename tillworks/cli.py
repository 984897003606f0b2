"""Jobs for spark-submit: full run, pending months, resumable marts, landed files."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillworks.plans import medallion, monthly
from tillworks.sources import transactions as X
from tillworks.sources.layers import LayerStore
from tillworks.sources.workbooks import ALL, FIRST
from tillworks.streaming import landing


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    run = jobs.add_parser("run", help="refresh every layer from the source and check it")
    run.add_argument("--source", required=True)
    run.add_argument("--format", default="csv", choices=["csv", "parquet", "xlsx"])
    run.add_argument("--all-sheets", action="store_true", help="every sheet of a workbook, not the first alone")
    run.add_argument("--cleaning", default="strict", choices=["strict", "lenient"])
    run.add_argument(
        "--date-format", action="append", help="layout of text dates, tried in order; repeatable"
    )
    run.add_argument("--as-of", help="day the customer marts count from; default today")

    months = jobs.add_parser("months", help="process pending months of the monthly mart")
    months.add_argument("--year", type=int)
    months.add_argument("--month", type=int, choices=range(1, 13))
    months.add_argument("--reset", action="store_true", help="empty the ledger and stop")
    months.add_argument("--dry-run", action="store_true", help="list the months only")

    marts = jobs.add_parser("marts", help="refresh product and country marts, resumable")
    marts.add_argument("--run-id")

    stream = jobs.add_parser("stream", help="take newly landed files through all layers")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--format", default="csv", choices=["csv"])
    stream.add_argument("--checkpoint", required=True)

    for job in (run, months, marts, stream):
        job.add_argument("--root", required=True, help="folder of the layers")
        job.add_argument(
            "--count-unknown", action="store_true",
            help="count the unknown customer as one; the same for all jobs of a root",
        )
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    """Run a job; returns 0, or 1 when a check of the full run failed."""
    args = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"tillworks-{args.job}").getOrCreate()
    store = LayerStore(spark, args.root, count_unknown=args.count_unknown)

    if args.job == "run":
        checks = medallion.run(
            spark, args.source, args.root, args.format, args.as_of, args.cleaning,
            args.date_format or X.DATE_FORMATS, args.count_unknown, ALL if args.all_sheets else FIRST,
        ).collect()  # a row per check
        failed = [c for c in checks if not c["passed"]]
        for c in failed:
            print(f"FAILED {c['check_name']}: {c['failing_rows']} rows")
        print(f"{len(checks) - len(failed)}/{len(checks)} checks passed")
        return 1 if failed else 0
    if args.job == "months":
        if args.reset:
            monthly.reset_ledger(store)
            return 0
        done = monthly.refresh_months(store, args.year, args.month, args.dry_run)
        print("pending" if args.dry_run else "processed", [f"{y}-{m:02d}" for y, m in done])
    elif args.job == "marts":
        print("run", monthly.refresh_marts(store, run_id=args.run_id))
    else:
        lines = landing.landing_lines(spark, args.landing, args.format)
        landing.refresh_touched_months(store, lines, args.checkpoint)
    return 0


if __name__ == "__main__":
    sys.exit(main())
