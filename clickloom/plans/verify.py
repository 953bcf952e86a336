"""Checks over what a run wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.sources import readers


def datasets(spark: SparkSession, output: str, run_id: str):
    """(dataset, format, reader) of everything a run writes."""
    yield "clickstream_cleaned", "parquet", lambda: readers.read_cleaned(spark, output, run_id)
    for name in schema.AGGREGATE_SCHEMAS:
        yield name, "parquet", lambda name=name: readers.read_aggregate(spark, output, name, run_id)
        yield name, "csv", lambda name=name: readers.read_report(spark, output, name, run_id)
    yield "user_activity", "parquet", lambda: readers.read_user_activity(spark, output, run_id)
    yield "run_summary", "parquet", lambda: readers.read_summary(spark, output, run_id)
    yield "corrupt_records", "text", lambda: readers.read_corrupt(spark, output, run_id)


def verify_outputs(spark: SparkSession, output: str, run_id: str) -> DataFrame:
    """Per dataset and format: is it there, how many rows, how many columns.

    ``corrupt_records`` is there only for a run with quarantine.
    """

    def inventory(dataset: str, fmt: str, read) -> DataFrame:
        labels = [F.lit(dataset).alias("dataset"), F.lit(fmt).alias("format")]
        df = readers.found(read)
        if df is None:
            return spark.range(1).select(
                *labels,
                F.lit(False).alias("found"),
                F.lit(None).cast("long").alias("rows"),
                F.lit(None).cast("int").alias("columns"),
            )
        return df.agg(F.count("*").alias("rows")).select(
            *labels,
            F.lit(True).alias("found"),
            "rows",
            F.lit(len(df.columns)).alias("columns"),
        )

    return reduce(
        DataFrame.unionAll, (inventory(*entry) for entry in datasets(spark, output, run_id))
    )


def reconcile_outputs(spark: SparkSession, output: str, run_id: str) -> DataFrame:
    """Counts that must agree: (check, expected, actual, ok).

    Every cleaned event is counted once by day, by region and hour, by device, by user
    and in the summary; each report has the rows of its aggregate; and every row of the
    input either fitted the schema or was set aside. A run from cleaned events alone has
    no counts of an input, and that check is left out.
    """
    events = readers.read_cleaned(spark, output, run_id).agg(F.count("*").alias("expected"))

    def sums(df: DataFrame, value: Column) -> DataFrame:
        return df.agg(F.coalesce(value, F.lit(0)).alias("n"))

    def aggregate(name: str, value: Column) -> DataFrame:
        return sums(readers.read_aggregate(spark, output, name, run_id), value)

    def compare(check: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
        return spark.range(1).select(
            F.lit(check).alias("check"),
            expected.scalar().alias("expected"),
            actual.scalar().alias("actual"),
        )

    checks = [
        compare(f"events in {name}", events, aggregate(name, F.sum(measure)))
        for name, measure in [
            ("daily_activity", "daily_events"),
            ("activity_by_region_hour", "total_events"),
            ("device_statistics", "session_count"),
        ]
    ]
    checks += [
        compare(
            f"report rows of {name}",
            aggregate(name, F.count("*")),
            readers.read_report(spark, output, name, run_id).agg(F.count("*").alias("n")),
        )
        for name in schema.AGGREGATE_SCHEMAS
    ]
    users = readers.read_user_activity(spark, output, run_id)
    summary = readers.read_summary(spark, output, run_id)
    checks += [
        compare("events in user_activity", events, sums(users, F.sum("total_sessions"))),
        compare("cleaned rows in run_summary", events, sums(summary, F.sum("cleaned_rows"))),
    ]
    if summary.where("raw_rows IS NOT NULL").count():
        corrupt = readers.found(lambda: readers.read_corrupt(spark, output, run_id))
        aside = F.lit(0) if corrupt is None else sums(corrupt, F.count("*")).scalar()
        raw, valid = (sums(summary, F.sum(c)) for c in ("raw_rows", "valid_rows"))
        both = spark.range(1).select((valid.scalar() + aside).alias("n"))
        checks.append(compare("valid and corrupt rows of the input", raw, both))
    checks.append(
        compare(
            "last rank of top_users",
            aggregate("top_users", F.count("*")),
            aggregate("top_users", F.max("rank")),
        )
    )
    return reduce(DataFrame.unionAll, checks).withColumn(
        "ok", F.col("expected") == F.col("actual")
    )
