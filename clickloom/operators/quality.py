"""Profiles and summaries: one row per input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.functions import unsummed


def raw_profile(raw: DataFrame) -> DataFrame:
    """Size, key cardinalities, time span and defect counts of raw rows.

    Counted per (user, region) first. Distinct counts of two columns make Spark copy
    every input row per column; done on the pairs, the copies are of groups only.

    The span is over text, and the least of a text cannot be kept in a hash table:
    grouped with the rest it would sort the whole input. It is a separate ungrouped
    pass, which reads one column and keeps two values per task.
    """
    pairs = raw.groupBy("user_id", "region").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("duration_sec") < 0).alias("negative_durations"),
        F.count_if(F.isnan("price")).alias("nan_prices"),
        unsummed("price").alias("unsummed_prices"),
    )
    no_user = F.col("user_id").isNull() | (F.col("user_id") == "")
    counts = pairs.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("region").alias("unique_regions"),
        F.coalesce(F.sum(F.when(no_user, F.col("rows"))), F.lit(0)).alias("blank_user_ids"),
        F.coalesce(F.sum("negative_durations"), F.lit(0)).alias("negative_durations"),
        F.coalesce(F.sum("nan_prices"), F.lit(0)).alias("nan_prices"),
        F.coalesce(F.sum("unsummed_prices"), F.lit(0)).alias("unsummed_prices"),
    )
    span = raw.agg(
        F.struct(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    ).scalar()
    return counts.select(
        "total_rows",
        "unique_users",
        "unique_regions",
        span["first"].alias("min_timestamp"),
        span["last"].alias("max_timestamp"),
        "blank_user_ids",
        "negative_durations",
        "nan_prices",
        "unsummed_prices",
    )


def run_summary(
    users: DataFrame,
    raw_rows: Column | int | None = None,
    valid_rows: Column | int | None = None,
    corrupt_rows: Column | int | None = None,
) -> DataFrame:
    """Row and column counts, date span, users and regions of cleaned events.

    ``users`` are rows of :func:`clickloom.operators.metrics.user_activity`. The counts of
    the input are given by whoever read it.
    """

    def given(rows: Column | int | None) -> Column:
        return (rows if isinstance(rows, Column) else F.lit(rows)).cast("long")

    return users.agg(
        F.coalesce(F.sum("total_sessions"), F.lit(0)).alias("cleaned_rows"),
        F.lit(len(schema.CLEANED_SCHEMA)).alias("column_count"),
        F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.count_distinct("region").alias("distinct_regions"),
        F.coalesce(F.sum("unsummed_prices"), F.lit(0)).alias("unsummed_prices"),
    ).select(
        given(raw_rows).alias("raw_rows"),
        given(valid_rows).alias("valid_rows"),
        given(corrupt_rows).alias("corrupt_rows"),
        "cleaned_rows",
        "column_count",
        "min_date",
        "max_date",
        "distinct_users",
        "distinct_regions",
        "unsummed_prices",
    )
