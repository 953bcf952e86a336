from __future__ import annotations

import re
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clickloom import __main__ as cli
from clickloom import schema
from clickloom.fixtures import raw as fixture
from clickloom.operators import metrics, quality
from clickloom.operators.cleaning import cleaned_events
from clickloom.plans import batch, verify
from clickloom.sources import readers, writers
from clickloom.fixtures.queries import RUN, written_rows
from clickloom.sources.scratch import SETTING, scratch_folder
from helpers import plan, rows


@pytest.fixture(scope="module")
def csv_path(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("input") / "clickstream")
    fixture.clickstream_raw(spark, small).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def output(spark, csv_path, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("output"))
    assert batch.run(spark, csv_path, out, "r1") == "r1"
    return out


def test_run_writes_what_the_operators_compute(spark, csv_path, output):
    cleaned = cleaned_events(readers.read_clickstream(spark, csv_path))
    assert rows(readers.read_cleaned(spark, output, "r1")) == rows(cleaned)
    for name, df in metrics.analyze(cleaned).items():
        assert rows(readers.read_aggregate(spark, output, name, "r1")) == rows(df)
        assert rows(readers.read_report(spark, output, name, "r1")) == rows(df)
    users = metrics.user_activity(cleaned)
    assert rows(readers.read_user_activity(spark, output, "r1")) == rows(users)
    summary = quality.run_summary(users, 1040, 1040, 0)
    assert rows(readers.read_summary(spark, output, "r1")) == rows(summary)


def test_the_input_is_read_once(spark, csv_path, tmp_path, monkeypatch):
    """With the input gone after the first write, the run still finishes."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    shutil.copytree(csv_path, source)
    write_cleaned = writers.write_cleaned

    def write_then_lose_the_input(*args):
        write_cleaned(*args)
        shutil.rmtree(source)

    monkeypatch.setattr(writers, "write_cleaned", write_then_lose_the_input)
    batch.run(spark, source, out, "r1")
    assert all(r.ok for r in verify.reconcile_outputs(spark, out, "r1").collect())


def test_quarantine_parses_the_text_once(spark, small, tmp_path, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    fixture.clickstream_lines(spark, small).write.text(source)
    read = []
    parse_lines = readers.parse_lines
    monkeypatch.setattr(readers, "parse_lines", lambda lines: read.append(lines) or parse_lines(lines))
    write_parsed = writers.write_parsed

    def write_then_lose_the_input(*args):
        assert plan(args[0]).count("Scan text") == 1
        write_parsed(*args)
        shutil.rmtree(source)

    monkeypatch.setattr(writers, "write_parsed", write_then_lose_the_input)
    batch.run(spark, source, out, "r1", quarantine=True)
    assert len(read) == 1
    assert all(r.ok for r in verify.reconcile_outputs(spark, out, "r1").collect())
    with pytest.raises(AnalysisException):  # deleted with the run finished
        readers.read_parsed(spark, out, "r1")


def test_aggregates_are_sorted_once(cleaned):
    """For the report, and not for the table before it."""
    for name, df in metrics.analyze(cleaned).items():
        if name != "top_users":
            assert "rangepartitioning" not in plan(df)
            assert plan(metrics.in_report_order(name, df)).count("rangepartitioning") == 1


def test_run_reconciles(spark, output):
    assert [r.ok for r in verify.reconcile_outputs(spark, output, "r1").collect()] == [True] * 11
    inventory = verify.verify_outputs(spark, output, "r1").collect()
    assert [r.dataset for r in inventory if not r.found] == ["corrupt_records"]
    assert len(inventory) == 12
    assert inventory[0]["columns"] == len(schema.CLEANED_SCHEMA)


def test_missing_outputs_are_listed_as_missing(spark, cleaned, tmp_path):
    writers.write_cleaned(cleaned, str(tmp_path), "r1")
    inventory = verify.verify_outputs(spark, str(tmp_path), "r1").collect()
    assert [r.dataset for r in inventory if r.found] == ["clickstream_cleaned"]
    assert [r["rows"] for r in inventory if not r.found] == [None] * 11


def test_disagreeing_outputs_fail_the_check(spark, csv_path, output, tmp_path):
    out = str(tmp_path)
    batch.run(spark, csv_path, out, "r1")
    short = readers.read_aggregate(spark, output, "daily_activity", "r1").limit(3)
    writers.write_aggregate(short, out, "daily_activity", "r1")
    failed = verify.reconcile_outputs(spark, out, "r1").where("NOT ok").collect()
    assert {r.check for r in failed} == {
        "events in daily_activity",
        "report rows of daily_activity",
    }


def test_quarantine_sets_malformed_lines_aside(spark, small, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines = fixture.clickstream_lines(spark, small)
    lines.write.text(source)
    batch.run(spark, source, out, "r1", quarantine=True)
    valid, corrupt = readers.split_corrupt(lines)
    assert rows(readers.read_corrupt(spark, out, "r1")) == rows(corrupt)
    assert rows(readers.read_cleaned(spark, out, "r1")) == rows(cleaned_events(valid))


def test_a_run_without_a_summary_is_not_the_latest(spark, output, cleaned):
    writers.write_cleaned(cleaned, output, "r2")  # cut short: no summary
    assert readers.latest_run_id(spark, output) == "r1"


def test_a_finished_run_is_not_replaced(spark, csv_path, output):
    assert readers.is_finished(spark, output, "r1")
    with pytest.raises(ValueError, match="already finished"):
        batch.run(spark, csv_path, output, "r1")


def test_a_run_that_was_cut_short_can_be_started_again(spark, csv_path, cleaned, tmp_path):
    out = str(tmp_path)
    stale = cleaned.withColumn("event_date", F.lit("1999-01-01").cast("date"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writers.write_cleaned(stale, out, "r1")
        assert not readers.is_finished(spark, out, "r1")
        batch.run(spark, csv_path, out, "r1")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert readers.is_finished(spark, out, "r1")
    back = readers.read_cleaned(spark, out, "r1")
    assert back.where("event_date < DATE'2000-01-01'").isEmpty()
    assert all(r.ok for r in verify.reconcile_outputs(spark, out, "r1").collect())


def test_no_run_at_all(spark, tmp_path):
    assert readers.latest_run_id(spark, str(tmp_path)) is None


def test_an_empty_input_is_a_finished_run(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(",".join(schema.RAW_SCHEMA.names) + "\n", encoding="utf-8")
    out = str(tmp_path / "out")
    batch.run(spark, str(source), out, "r1")
    summary = readers.read_summary(spark, out, "r1").first()
    assert (summary.cleaned_rows, summary.distinct_users, summary.min_date) == (0, 0, None)
    assert readers.read_report(spark, out, "top_users", "r1").count() == 0


def test_run_ids_grow_with_time():
    assert re.fullmatch(r"\d{8}_\d{6}", batch.new_run_id())


def test_command_line(spark, csv_path, tmp_path, capsys):
    out = str(tmp_path)
    assert cli.main(["verify", "--output", out]) == 1
    assert cli.main(["profile", "--input", csv_path]) == 0
    assert "1040" in capsys.readouterr().out
    assert cli.main(["run", "--input", csv_path, "--output", out, "--run-id", "r1"]) == 0
    assert cli.main(["verify", "--output", out]) == 0
    printed = capsys.readouterr().out
    assert "run r1" in printed and "last rank of top_users" in printed


def test_command_line_with_quarantine(spark, small, tmp_path, capsys):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    fixture.clickstream_lines(spark, small).write.text(source)
    arguments = ["--input", source, "--output", out, "--run-id", "r1", "--quarantine"]
    assert cli.main(["run", *arguments, "--double-money", "--single-file"]) == 0
    assert "malformed lines: 75" in capsys.readouterr().out


def test_scratch_folder_is_under_the_shared_one(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first.startswith(shared) and first != second
    spark.conf.set(SETTING, str(tmp_path))
    try:
        assert scratch_folder(spark).startswith(str(tmp_path))
    finally:
        spark.conf.unset(SETTING)


def test_input_is_accounted_for(spark, small, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    fixture.clickstream_lines(spark, small).write.text(source)
    batch.run(spark, source, out, "r1", quarantine=True)
    summary = readers.read_summary(spark, out, "r1").first()
    assert (summary.raw_rows, summary.valid_rows, summary.corrupt_rows) == (1040, 965, 75)
    assert all(r.ok for r in verify.reconcile_outputs(spark, out, "r1").collect())
    writers.write_corrupt(readers.read_corrupt(spark, out, "r1").limit(70), out, "r1")
    failed = verify.reconcile_outputs(spark, out, "r1").where("NOT ok").collect()
    assert [r.check for r in failed] == ["valid and corrupt rows of the input"]


def test_line_breaks_in_values_reconcile(spark, cleaned, tmp_path):
    odd = cleaned.withColumn("region", F.lit("X\nY"))
    batch.load(odd, metrics.analyze, str(tmp_path), "r1")
    assert all(r.ok for r in verify.reconcile_outputs(spark, str(tmp_path), "r1").collect())


def test_a_run_scans_the_cleaned_table_once_for_users_and_summary(spark, cleaned, tmp_path):
    writers.write_user_activity(metrics.user_activity(cleaned), str(tmp_path), "r1")
    users = readers.read_user_activity(spark, str(tmp_path), "r1")
    for df in (metrics.analyze(cleaned, users)["top_users"], quality.run_summary(users)):
        assert plan(df).count("Scan parquet") == 1 and "price:double" not in plan(df)


@pytest.mark.parametrize("broken", ["daily_activity", "device_statistics", "top_users", "activity_by_region_hour"])
def test_a_broken_output_shows_in_the_written_rows(spark, cleaned, tmp_path, broken):
    out = str(tmp_path)
    batch.load(cleaned, metrics.analyze, out, RUN)
    before = rows(written_rows(spark, out))
    short = spark.createDataFrame(
        readers.read_aggregate(spark, out, broken, RUN).limit(2).collect(), schema.AGGREGATE_SCHEMAS[broken]
    )
    writers.write_aggregate(short, out, broken, RUN)
    assert rows(written_rows(spark, out)) != before
