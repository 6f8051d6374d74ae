"""Run one job: ``spark-submit ... -m millrace <job> --root <folder> [--as-of 2024-01-31] [--since 2024-01-29]``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from millrace.plans.jobs import JOBS
from millrace.schema import Settings


def main() -> None:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="folder every executor can reach")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--since", type=date.fromisoformat, help="refresh only the days from then on")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"millrace-{args.job}").getOrCreate()
    result = JOBS[args.job](spark, Settings(root=args.root), args.as_of, args.since)
    if isinstance(result, (dict, int, bool)):
        print(result)


if __name__ == "__main__":
    main()
