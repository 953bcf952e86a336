"""Where a run keeps its datasets.

Each dataset is one folder with a ``run_id=<id>`` partition per run, so a dataset can
be read for one run, or for all of them with the run as a column::

    <output>/cleaned_data/clickstream_cleaned/run_id=<id>/event_date=<day>/
    <output>/aggregated/<name>/run_id=<id>/            the aggregates and user_activity
    <output>/reports/<name>_report/run_id=<id>/
    <output>/corrupt_records/run_id=<id>/
    <output>/run_summary/run_id=<id>/

and, while a run is going on, its parsed input::

    <output>/parsed_input/run_id=<id>/corrupt=<true|false>/
"""

from __future__ import annotations

import re


def cleaned_path(output: str) -> str:
    return f"{output}/cleaned_data/clickstream_cleaned"


def aggregate_path(output: str, name: str) -> str:
    return f"{output}/aggregated/{name}"


def report_path(output: str, name: str) -> str:
    return f"{output}/reports/{name}_report"


def corrupt_path(output: str) -> str:
    return f"{output}/corrupt_records"


def parsed_path(output: str) -> str:
    return f"{output}/parsed_input"


def summary_path(output: str) -> str:
    return f"{output}/run_summary"


def run_path(dataset: str, run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id {run_id!r}: only letters, digits and . _ - are allowed")
    return f"{dataset}/run_id={run_id}"
