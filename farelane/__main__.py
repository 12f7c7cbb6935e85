"""Run the active reports of a job type: ``python -m farelane <job_type> [date | --from-date --to-date]``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from farelane.functions.calendar import Span, level_for
from farelane.operators.runlog import active_jobs
from farelane.plans.catalog import report
from farelane.plans.runner import Job, log_to, run_batch
from farelane.session import build_session
from farelane.sources.star import Star


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    """Run the batch and return its status rows.

    A date range is one back-fill span, hence one Spark job per report.
    """
    parser = argparse.ArgumentParser(prog="farelane")
    parser.add_argument("job_type")
    parser.add_argument("date", nargs="?")
    parser.add_argument("--from-date")
    parser.add_argument("--to-date")
    parser.add_argument("--schema", default="gold")
    parser.add_argument("--registry", default="etl_job")
    parser.add_argument("--output", required=True)
    parser.add_argument("--keep-days", type=int, default=30, help="published periods that ended longer ago are removed")
    parser.add_argument("--workers", type=int, default=1, help="reports that run at once")
    args = parser.parse_args(argv)
    if bool(args.from_date) != bool(args.to_date):
        raise ValueError("--from-date and --to-date go together")
    level = level_for(args.job_type)
    span = Span.backfill(level, args.from_date, args.to_date) if args.from_date else Span.containing(level, args.date)
    chosen = [row.asDict() for row in active_jobs(spark.table(f"{args.schema}.{args.registry}"), args.job_type).collect()]
    if not chosen:
        raise ValueError(f"no active job of type {args.job_type}")
    jobs = [
        Job(
            name=(name := row["table_name"]), report=report(name), csv_path=f"{args.output}/csv", mart_path=f"{args.output}/mart/{name}",
            keep_days=args.keep_days, definition=row.get("sql_path"), job_type=args.job_type,
            delete_column=row.get("delete_column"), delete_condition=row.get("delete_condition"),
        )
        for row in chosen
    ]
    return run_batch(Star(spark, args.schema), [span], jobs, log_to(spark, f"{args.output}/run_log", jobs), args.workers)


if __name__ == "__main__":
    run(build_session(), sys.argv[1:]).show(truncate=False)
