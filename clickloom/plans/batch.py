"""The batch run: raw files in, cleaned events, aggregates and reports out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.cleaning import cleaned_events
from clickloom.operators.metrics import analyze, user_activity
from clickloom.operators.quality import run_summary
from clickloom.sources import readers, writers


def new_run_id() -> str:
    """A run id from the current time; later runs have greater ids."""
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def load(
    cleaned: DataFrame,
    analyzer: Callable[[DataFrame, DataFrame], dict[str, DataFrame]],
    output: str,
    run_id: str,
    counts: dict[str, int] | None = None,
    exact_money: bool = True,
    single_file: bool = False,
    events_per_file: int = writers.EVENTS_PER_FILE,
) -> None:
    """Write cleaned events once and derive everything else from the written copy.

    The written table cuts the lineage: the input is deduplicated once, and aggregates
    then read only the columns they need. Facts per user and region are written next;
    the top users and the summary come from them. ``analyzer`` is given both tables. If
    executors are lost later, the work is redone from Parquet rather than from the raw
    files. The summary, with the input's ``counts``, is written last and marks the run
    as finished.
    """
    spark = cleaned.sparkSession
    writers.write_cleaned(cleaned, output, run_id, events_per_file)
    written = readers.read_cleaned(spark, output, run_id)
    writers.write_user_activity(user_activity(written, exact_money), output, run_id)
    users = readers.read_user_activity(spark, output, run_id)
    results = analyzer(written, users)
    writers.write_aggregates(results, output, run_id)
    writers.write_reports(spark, output, run_id, tuple(results), single_file)
    writers.write_summary(run_summary(users, **(counts or {})), output, run_id)


def run(
    spark: SparkSession,
    input_path: str,
    output: str,
    run_id: str | None = None,
    quarantine: bool = False,
    exact_money: bool = True,
    single_file: bool = False,
    events_per_file: int = writers.EVENTS_PER_FILE,
) -> str:
    """Process raw CSV files into one run under ``output``; return its id.

    With ``quarantine`` lines that do not fit the schema are written to
    ``corrupt_records`` and left out; otherwise their unreadable cells become NULL.

    With ``quarantine`` the text is read and parsed once, into a Parquet table that the
    counts, the corrupt lines and the cleaning read; it is deleted when the run is
    finished. Without, a pass of its own counts the rows (it splits lines and parses no
    cell, which costs less than that table) and the cleaning parses them. Counts taken
    in flight would count the rows of a repeated stage twice.

    A run that was cut short can be started again under its id. A finished one cannot:
    its readers would see it half replaced.
    """
    run_id = run_id or new_run_id()
    if readers.is_finished(spark, output, run_id):
        raise ValueError(f"run {run_id} is already finished")
    if quarantine:
        parsed = readers.parse_lines(readers.read_lines(spark, input_path))
        writers.write_parsed(parsed, output, run_id)
        raw, corrupt = readers.read_parsed(spark, output, run_id)
        writers.write_corrupt(corrupt, output, run_id)
        valid, aside = raw.count(), corrupt.count()
    else:
        raw = readers.read_clickstream(spark, input_path)
        valid, aside = raw.count(), 0
    counts = {"raw_rows": valid + aside, "valid_rows": valid, "corrupt_rows": aside}
    load(
        cleaned_events(raw),
        lambda cleaned, users: analyze(cleaned, users, exact_money),
        output,
        run_id,
        counts,
        exact_money,
        single_file,
        events_per_file,
    )
    if quarantine:
        writers.drop_parsed(spark, output, run_id)
    return run_id
