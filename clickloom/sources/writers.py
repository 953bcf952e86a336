"""Writers. Each replaces the folder of its own run and nothing else."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.operators.metrics import report_order
from clickloom.sources import layout
from clickloom.sources.readers import read_aggregate
from clickloom.sources.scratch import delete_folder

#: Cleaned events in a file, about; some 300 MB of Parquet.
EVENTS_PER_FILE = 4_000_000
#: Rows in a report file at most, unless a single file is asked for.
REPORT_ROWS_PER_FILE = 1_000_000


def write_parsed(parsed: DataFrame, output: str, run_id: str) -> None:
    """The parsed input of a run, apart by whether a row was set aside.

    The one pass over the text: counts, corrupt lines and cleaning read from here.
    """
    (
        parsed.withColumn("corrupt", F.col(schema.CORRUPT_COLUMN).isNotNull())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("corrupt")
        .parquet(layout.run_path(layout.parsed_path(output), run_id))
    )


def drop_parsed(spark: SparkSession, output: str, run_id: str) -> None:
    """Delete the parsed input of a run that needs it no longer."""
    delete_folder(spark, layout.run_path(layout.parsed_path(output), run_id))


def deal_by_day(cleaned: DataFrame, events_per_file: int = EVENTS_PER_FILE) -> DataFrame:
    """Cleaned events dealt to tasks, a day in as many as its events need.

    After deduplication every task holds rows of every day and would open a file for
    each. Events are counted per day; a day above ``events_per_file`` is cut into buckets
    by a hash of the event's key, and its buckets go to tasks that follow each other, so
    no two of them meet unless there are more of them than tasks. Any other day goes to
    one task. The tasks are ``spark.sql.shuffle.partitions``, whatever adaptive execution
    is allowed to do.

    The count is taken from the shuffle of the deduplication, which Spark reuses for the
    rows: the input is not read again. What is broadcast has a row for each day above
    ``events_per_file``, so at most the rows over ``events_per_file``, and never more
    than there are days.
    """
    tasks = int(cleaned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = F.ceil(F.count("*") / events_per_file).cast("int")
    per_day = cleaned.groupBy(F.col("event_date").alias("_day")).agg(buckets.alias("_buckets"))
    large = F.broadcast(per_day.where("_buckets > 1"))
    bucket = F.pmod(F.xxhash64(*schema.DEDUPE_KEYS), F.coalesce("_buckets", F.lit(1)))
    task = F.pmod(F.hash("event_date") + bucket, F.lit(tasks)).cast("int")
    return (
        # null-safe: a test for NULL days on one side only would part the two shuffles
        cleaned.join(large, F.col("event_date").eqNullSafe(F.col("_day")), "left")
        .withColumn("_task", task)
        .repartitionById(tasks, "_task")
        .select(*cleaned.columns)
    )


def write_cleaned(
    cleaned: DataFrame, output: str, run_id: str, events_per_file: int = EVENTS_PER_FILE
) -> None:
    """Cleaned events as Parquet, one folder per event_date, dealt by :func:`deal_by_day`.

    Where a day has more buckets than there are tasks, its files are cut at twice
    ``events_per_file``.
    """
    (
        deal_by_day(cleaned, events_per_file)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # no days left over from an attempt
        .option("maxRecordsPerFile", 2 * events_per_file)
        .partitionBy("event_date")
        .parquet(layout.run_path(layout.cleaned_path(output), run_id))
    )


def write_user_activity(users: DataFrame, output: str, run_id: str) -> None:
    """Facts per user and region as Parquet."""
    path = layout.run_path(layout.aggregate_path(output, "user_activity"), run_id)
    users.write.mode("overwrite").parquet(path)


def write_aggregate(df: DataFrame, output: str, name: str, run_id: str) -> None:
    """One aggregate as Parquet."""
    path = layout.run_path(layout.aggregate_path(output, name), run_id)
    df.write.mode("overwrite").parquet(path)


def write_report(
    df: DataFrame,
    output: str,
    name: str,
    run_id: str,
    single_file: bool = False,
    rows_per_file: int = REPORT_ROWS_PER_FILE,
) -> None:
    """One aggregate as delimited text with a header, in report order.

    Range-partitioned, so several files are ordered in sequence; adaptive execution
    merges small ones. Values may hold line breaks, so a file cannot be split when it is
    read: none has more than ``rows_per_file`` rows. ``single_file`` asks for exactly
    one, written by one task and read by one.
    """
    ordered = df.orderBy(*report_order(name))
    if single_file:
        ordered = ordered.coalesce(1)
    (
        ordered.write.mode("overwrite")
        .option("maxRecordsPerFile", 0 if single_file else rows_per_file)
        .options(
            header=True,
            sep=schema.REPORT_DELIMITER,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(layout.run_path(layout.report_path(output, name), run_id))
    )


def write_corrupt(corrupt: DataFrame, output: str, run_id: str) -> None:
    """Lines that did not fit the schema, exactly as they were read."""
    path = layout.run_path(layout.corrupt_path(output), run_id)
    corrupt.select(schema.CORRUPT_COLUMN).write.mode("overwrite").text(path)


def write_summary(summary: DataFrame, output: str, run_id: str) -> None:
    """The one-row summary. Written last, it marks the run as finished."""
    path = layout.run_path(layout.summary_path(output), run_id)
    summary.write.mode("overwrite").parquet(path)


def write_aggregates(results: dict[str, DataFrame], output: str, run_id: str) -> None:
    """All aggregates as Parquet."""
    spark = next(iter(results.values())).sparkSession
    _side_by_side(
        spark, lambda name: write_aggregate(results[name], output, name, run_id), tuple(results)
    )


def write_reports(
    spark: SparkSession,
    output: str,
    run_id: str,
    names=tuple(schema.AGGREGATE_SCHEMAS),
    single_file: bool = False,
) -> None:
    """Reports of the written aggregates, so both copies agree and none is recomputed."""

    def write(name: str) -> None:
        written = read_aggregate(spark, output, name, run_id)
        write_report(written, output, name, run_id, single_file)

    _side_by_side(spark, write, names)


def _side_by_side(spark: SparkSession, job, names) -> None:
    """Submit independent jobs together, so one's last tasks leave no executor idle.

    Each job is wrapped on its own: a wrapper holds one copy of the caller's local
    properties, which concurrent jobs must not share.
    """
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job), n) for n in names]
        for each in started:
            each.result()
