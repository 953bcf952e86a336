"""Every operator over a table directory, as ``(spark, sf_dir) -> DataFrame``.

Queries about readers and writers write to a fresh scratch folder and return what they
read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.fixtures.raw import clickstream_lines, clickstream_raw
from clickloom.functions import (
    parse_event_time,
    price_category,
    session_category,
    time_features,
)
from clickloom.operators import cleaning, metrics, quality
from clickloom.plans import batch, verify
from clickloom.sources import readers, writers
from clickloom.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

RUN = "20240101_000000"
LATER_RUN = "20240102_000000"


def on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(clickstream_raw(spark, sf_dir))


def on_cleaned(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: operator(cleaning.cleaned_events(raw)))


def on_activity(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return on_cleaned(lambda c: operator(metrics.activity_by_region_hour(c)))


def on_daily(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return on_cleaned(lambda c: operator(metrics.daily_activity(c)))


def _time_features(raw: DataFrame) -> DataFrame:
    return raw.select(parse_event_time().alias("event_timestamp")).withColumns(time_features())


def _read_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_clickstream(spark, write_csv(spark, sf_dir, scratch_folder(spark)))


def write_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/clickstream"
    clickstream_raw(spark, sf_dir).write.option("header", True).csv(path)
    return path


def _valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.split_corrupt(clickstream_lines(spark, sf_dir))[0]


def _corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.split_corrupt(clickstream_lines(spark, sf_dir))[1]


def _write_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    writers.write_corrupt(_corrupt_rows(spark, sf_dir), folder, RUN)
    return readers.read_corrupt(spark, folder, RUN)


def _read_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    writers.write_cleaned(
        cleaning.cleaned_events(clickstream_raw(spark, sf_dir)), folder, RUN
    )
    return readers.read_cleaned(spark, folder, RUN)


def _write_one(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = scratch_folder(spark)
    cleaned = cleaning.cleaned_events(clickstream_raw(spark, sf_dir))
    result = metrics.analyze(cleaned)[name]
    writers.write_aggregate(result, folder, name, RUN)
    return folder


def aggregate_round_trip(name: str) -> Query:
    return lambda spark, sf_dir: readers.read_aggregate(
        spark, _write_one(spark, sf_dir, name), name, RUN
    )


def report_round_trip(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _write_one(spark, sf_dir, name)
        writers.write_reports(spark, folder, RUN, [name])
        return readers.read_report(spark, folder, name, RUN)

    return query


def _summary(cleaned: DataFrame) -> DataFrame:
    return quality.run_summary(metrics.user_activity(cleaned))


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = clickstream_raw(spark, sf_dir)
    rows = raw.agg(F.count("*")).scalar()
    users = metrics.user_activity(cleaning.cleaned_events(raw))
    return quality.run_summary(users, rows, rows, 0)


def _latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    raw = clickstream_raw(spark, sf_dir)
    rejected = cleaning.filter_valid(raw).transform(cleaning.enrich)
    writers.write_summary(_summary(rejected), folder, RUN)
    cleaned = cleaning.cleaned_events(raw)
    writers.write_summary(_summary(cleaned), folder, LATER_RUN)
    runs = readers.read_summary(spark, folder)
    return readers.latest_run(runs, runs)


def written_rows(spark: SparkSession, folder: str, quarantine: bool = False) -> DataFrame:
    """Every row of every dataset of a run, in one layout.

    ``key`` names the row; its counts and its amounts stand in two columns each.
    """
    layouts = {
        "clickstream_cleaned": (
            ("user_id", "session_id", "timestamp", "action", "device"),
            ("duration_sec", "event_hour", "price", None),
        ),
        "activity_by_region_hour": (
            ("region", "event_date", "event_hour"),
            ("total_events", "unique_users", "total_revenue", "avg_price"),
        ),
        "device_statistics": (
            ("device", "session_category"),
            ("session_count", "unique_users", "avg_duration", None),
        ),
        "top_users": (
            ("rank", "user_id", "region"),
            ("total_sessions", "total_time", "total_spent", None),
        ),
        "daily_activity": (
            ("event_date",),
            ("daily_events", "daily_users", "daily_revenue", None),
        ),
        "user_activity": (
            ("user_id", "region", "first_date", "last_date"),
            ("total_sessions", "total_time", "total_spent", "unsummed_prices"),
        ),
        "run_summary": (
            ("min_date", "max_date", "raw_rows", "valid_rows", "corrupt_rows"),
            ("cleaned_rows", "distinct_users", "distinct_regions", "unsummed_prices"),
        ),
        "corrupt_records": ((schema.CORRUPT_COLUMN,), (None, None, None, None)),
    }

    def rows(dataset: str, fmt: str, df: DataFrame) -> DataFrame:
        keys, (count, users, amount, mean) = layouts[dataset]
        value = lambda name: F.col(name) if name else F.lit(None)
        texts = (F.coalesce(F.col(key).cast("string"), F.lit("-")) for key in keys)
        return df.select(
            F.lit(dataset).alias("dataset"),
            F.lit(fmt).alias("format"),
            F.concat_ws("|", *texts).alias("key"),
            value(count).cast("long").alias("count"),
            value(users).cast("long").alias("users"),
            value(amount).cast("double").alias("amount"),
            value(mean).cast("double").alias("mean"),
        )

    found = [
        rows(dataset, fmt, read())
        for dataset, fmt, read in verify.datasets(spark, folder, RUN)
        if quarantine or dataset != "corrupt_records"
    ]
    return reduce(DataFrame.unionAll, found)


def _load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    cleaned = cleaning.cleaned_events(clickstream_raw(spark, sf_dir))
    batch.load(cleaned, metrics.analyze, folder, RUN)
    return written_rows(spark, folder)


def _quarantined_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    clickstream_lines(spark, sf_dir).write.text(f"{folder}/lines")
    batch.run(spark, f"{folder}/lines", folder, RUN, quarantine=True)
    return written_rows(spark, folder, quarantine=True)


def _verify_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verify_outputs(spark, whole_run(spark, sf_dir), RUN)


def _reconcile_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.reconcile_outputs(spark, whole_run(spark, sf_dir), RUN)


def whole_run(spark: SparkSession, sf_dir: str) -> str:
    """CSV lines to a finished run with quarantine; returns the folder it is in."""
    folder = scratch_folder(spark)
    clickstream_lines(spark, sf_dir).write.text(f"{folder}/lines")
    batch.run(spark, f"{folder}/lines", folder, RUN, quarantine=True)
    return folder


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return {
        # cleaning
        "clickstream_raw": clickstream_raw,
        "dedupe_events": on_raw(cleaning.dedupe_events),
        "fill_defaults": on_raw(cleaning.fill_defaults),
        "filter_valid": on_raw(cleaning.filter_valid),
        "parse_event_time": on_raw(
            lambda raw: raw.select("timestamp", parse_event_time().alias("event_timestamp"))
        ),
        "time_features": on_raw(_time_features),
        "session_category": on_raw(
            lambda raw: raw.select("duration_sec", session_category().alias("session_category"))
        ),
        "price_category": on_raw(
            lambda raw: raw.select("price", price_category().alias("price_category"))
        ),
        "enrich": on_raw(cleaning.enrich),
        "cleaned_events": on_raw(cleaning.cleaned_events),
        # metrics
        "activity_by_region_hour": on_cleaned(metrics.activity_by_region_hour),
        "device_statistics": on_cleaned(metrics.device_statistics),
        "user_activity": on_cleaned(metrics.user_activity),
        "top_users": on_cleaned(metrics.top_users),
        "daily_activity": on_cleaned(metrics.daily_activity),
        "region_rollup": on_activity(metrics.region_rollup),
        "top_regions": on_activity(metrics.top_regions),
        "recent_days": on_daily(metrics.recent_days),
        "distinct_users": on_cleaned(metrics.distinct_users),
        "distinct_regions": on_cleaned(metrics.distinct_regions),
        "cleaned_sample": on_cleaned(metrics.cleaned_sample),
        "daily_sample": on_daily(metrics.daily_sample),
        # quality
        "raw_profile": on_raw(quality.raw_profile),
        "run_summary": _run_summary,
        # sources and sinks
        "read_clickstream": _read_clickstream,
        "valid_rows": _valid_rows,
        "corrupt_rows": _corrupt_rows,
        "write_corrupt": _write_corrupt,
        "read_cleaned": _read_cleaned,
        **{f"aggregate_{name}": aggregate_round_trip(name) for name in schema.AGGREGATE_SCHEMAS},
        **{f"report_{name}": report_round_trip(name) for name in schema.AGGREGATE_SCHEMAS},
        "latest_run": _latest_run,
        "load": _load,
        # whole runs, from CSV files
        "quarantined_run": _quarantined_run,
        "verify_outputs": _verify_outputs,
        "reconcile_outputs": _reconcile_outputs,
    }
