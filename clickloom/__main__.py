"""Command line, for ``spark-submit`` or ``python -m clickloom``.

    profile --input <csv path>
    run --input <csv path> --output <folder> [--run-id ID] [--quarantine]
        [--double-money] [--single-file] [--events-per-file N]
    verify --output <folder> [--run-id ID]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.operators import metrics
from clickloom.operators.quality import raw_profile
from clickloom.plans import batch, verify
from clickloom.sources import readers, writers


def _show_sample(spark: SparkSession, output: str, run_id: str, columns: list[str], rows: int):
    """The earliest cleaned events, looked for in the folder of the first day only."""
    first_day = readers.read_summary(spark, output, run_id).select("min_date").scalar()
    cleaned = readers.read_cleaned(spark, output, run_id).where(F.col("event_date") == first_day)
    sample = metrics.cleaned_sample(cleaned.select("event_timestamp", *columns), rows)
    sample.drop("event_timestamp").show(truncate=False)


def _show_run(spark: SparkSession, output: str, run_id: str) -> None:
    activity = readers.read_aggregate(spark, output, "activity_by_region_hour", run_id)
    daily = readers.read_aggregate(spark, output, "daily_activity", run_id)
    readers.read_summary(spark, output, run_id).show(truncate=False)
    columns = ["user_id", "action", "event_date", "region", "duration_sec"]
    _show_sample(spark, output, run_id, columns, schema.CLEANED_SAMPLE_ROWS)
    metrics.top_regions(activity).show(truncate=False)
    metrics.recent_days(daily).show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clickloom")
    commands = parser.add_subparsers(dest="command", required=True)
    profile = commands.add_parser("profile", help="count rows and defects of raw CSV files")
    profile.add_argument("--input", required=True)
    run = commands.add_parser("run", help="process raw CSV files")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--run-id")
    run.add_argument("--quarantine", action="store_true", help="set malformed lines aside")
    run.add_argument("--double-money", action="store_true", help="sum money as doubles")
    run.add_argument("--single-file", action="store_true", help="exactly one file per report")
    run.add_argument("--events-per-file", type=int, default=writers.EVENTS_PER_FILE, help="cleaned")
    check = commands.add_parser("verify", help="check what a run wrote")
    check.add_argument("--output", required=True)
    check.add_argument("--run-id", help="default: the latest finished run")
    args = parser.parse_args(argv)

    # Master, memory and shuffle settings come from spark-submit.
    spark = SparkSession.builder.appName("clickloom").getOrCreate()
    if args.command == "profile":
        raw_profile(readers.read_clickstream(spark, args.input)).show(truncate=False)
        return 0
    if args.command == "run":
        run_id = batch.run(
            spark,
            args.input,
            args.output,
            args.run_id,
            quarantine=args.quarantine,
            exact_money=not args.double_money,
            single_file=args.single_file,
            events_per_file=args.events_per_file,
        )
        print(f"run {run_id} written to {args.output}")
        if args.quarantine:
            print(f"malformed lines: {readers.read_corrupt(spark, args.output, run_id).count()}")
        _show_run(spark, args.output, run_id)
        return 0

    run_id = args.run_id or readers.latest_run_id(spark, args.output)
    if run_id is None:
        print(f"no finished run under {args.output}")
        return 1
    print(f"run {run_id}")
    verify.verify_outputs(spark, args.output, run_id).show(truncate=False)
    _show_sample(spark, args.output, run_id, ["user_id", "action", "event_date"], 3)
    checks = verify.reconcile_outputs(spark, args.output, run_id)
    checks.show(truncate=False)
    return 0 if checks.where("NOT coalesce(ok, false)").isEmpty() else 1


if __name__ == "__main__":
    raise SystemExit(main())
