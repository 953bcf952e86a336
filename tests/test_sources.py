from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.operators import metrics, quality
from clickloom.operators.cleaning import cleaned_events
from clickloom.sources import layout, readers, writers
from helpers import event, optimized, plan, raw_frame, rows

HEADER = "user_id,session_id,action,timestamp,region,device,duration_sec,product_id,price"
LINES = {
    "normal": "u1,s1,click,2024-01-07 10:11:12,Москва,mobile,30,p1,50.0",
    "blank": ",s2,view,2024-01-08 01:00:00,,tablet,60,p2,100.0",
    "quoted blank": '"",s2b,view,2024-01-08 01:00:00,"",tablet,300,p2,500.0',
    "bad timestamp": "u3,,click,2024-13-45 25:61:61,X,mobile,301,p3,500.01",
    "bad int": "u4,s4,click,2024-01-09 00:00:00,X,mobile,abc,p3,10.0",
    "negative": "u5,s5,click,2024-01-09 00:00:00,X,mobile,-5,p3,10.0",
    "nan": "u6,s6,click,2024-01-09 00:00:00,X,mobile,5,p3,NaN",
    "extra cell": "u7,s7,click,2024-01-09 00:00:00,X,mobile,5,p3,1.0,EXTRA",
    "short": "u8,s8,click,2024-01-09 00:00:00,X",
    "loose time": "u9,s9,click,2024-1-9 1:2:3,X,mobile,5,p3,1.0",
    "blank price": "u10,s10,click,2024-01-09 00:00:00,X,,5,p3,",
}
CORRUPT = sorted(LINES[k] for k in ("bad int", "extra cell", "short"))


@pytest.fixture()
def folder(tmp_path):
    """Two files, each with a header, one with blank lines."""
    lines = list(LINES.values())
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines[:6], ""]), encoding="utf-8")
    (tmp_path / "b.csv").write_text(
        "\n".join([HEADER, "", *lines[6:], " \t", ""]), encoding="utf-8"
    )
    return str(tmp_path)


def by_session(df) -> dict:
    return {r.session_id: r for r in df.collect()}


def test_read_clickstream(spark, folder):
    df = readers.read_clickstream(spark, folder)
    assert df.schema == schema.RAW_SCHEMA
    got = by_session(df)
    assert len(got) == len(LINES)
    assert tuple(got["s1"]) == (
        "u1", "s1", "click", "2024-01-07 10:11:12", "Москва", "mobile", 30, "p1", 50.0,
    )
    assert got["s2"].user_id is None and got["s2"].region is None
    assert got["s2b"].user_id is None and got["s2b"].region is None
    assert got[None].timestamp == "2024-13-45 25:61:61"
    assert got["s4"].duration_sec is None and got["s4"].price == 10.0
    assert math.isnan(got["s6"].price)
    assert got["s7"].price == 1.0
    assert (got["s8"].region, got["s8"].device, got["s8"].price) == ("X", None, None)
    assert got["s10"].device is None and got["s10"].price is None


def test_cleaning_what_was_read(spark, folder):
    cleaned = by_session(cleaned_events(readers.read_clickstream(spark, folder)))
    assert sorted(cleaned) == ["s1", "s2", "s2b", "s6", "s7"]
    assert cleaned["s2"].user_id == "unknown_user" and cleaned["s2"].region == "Неизвестно"
    assert cleaned["s1"].event_dayofweek == 1
    assert (cleaned["s2"].session_category, cleaned["s2"].price_category) == ("medium", "medium")


def test_split_corrupt(spark, folder):
    valid, corrupt = readers.split_corrupt(readers.read_lines(spark, folder))
    assert valid.schema == schema.RAW_SCHEMA
    assert sorted(r[0] for r in corrupt.collect()) == CORRUPT
    everything = readers.read_clickstream(spark, folder)
    fine = everything.where(
        ~F.coalesce(F.col("session_id").isin("s4", "s7", "s8"), F.lit(False))
    )
    assert str(rows(valid)) == str(rows(fine))  # as text, since NaN differs from itself


@pytest.mark.parametrize("columns", [["user_id"], ["price"], ["duration_sec", "action"]])
def test_corrupt_lines_do_not_depend_on_the_columns_read(spark, folder, columns):
    valid, corrupt = readers.split_corrupt(readers.read_lines(spark, folder))
    assert valid.select(*columns).count() == len(LINES) - 3
    assert corrupt.count() == 3


def test_both_ways_of_reading_agree_on_odd_lines(spark, tmp_path):
    """Valid rows and re-read corrupt lines make up what the plain reader gives."""
    rnd = random.Random(11)
    text = ["a", "", '""', '"q,q"', '"open', 'x"y', "\\", '"a\\"b"', " pad ", "#c", "é", "'"]
    whole = ["7", "-1", "", " 5", "5 ", "+3", "2.5", "99999999999", "abc"]
    real = ["2.5", "7", "", "NaN", "Infinity", "1e3", "-0.0", "x"]

    def line():
        cells = [rnd.choice([*"abcdef", rnd.choice(text)]) for _ in range(6)]
        cells += [rnd.choice(["1", "2", rnd.choice(whole)]), "p"]
        cells.append(rnd.choice(["1.5", rnd.choice(real)]))
        return ",".join(cells[: rnd.choice([9] * 12 + [1, 5, 8])] + ["more"] * (rnd.random() < 0.05))

    def write(name, lines):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.csv").write_text("\n".join([HEADER, *lines, ""]), encoding="utf-8")
        return str(folder)

    def counted(df):
        return Counter(str(tuple(r)) for r in df.collect())

    source = write("all", [line() for _ in range(5_000)])
    valid, corrupt = readers.split_corrupt(readers.read_lines(spark, source))
    aside = [r[0] for r in corrupt.collect()]
    assert 500 < len(aside) < 4_500
    again = readers.read_clickstream(spark, write("aside", aside))
    assert counted(valid) + counted(again) == counted(readers.read_clickstream(spark, source))


def test_each_line_is_parsed_once(spark, folder):
    for df in readers.split_corrupt(readers.read_lines(spark, folder)):
        assert optimized(df).count("from_csv") == 1


def test_corrupt_round_trip(spark, folder, tmp_path):
    _, corrupt = readers.split_corrupt(readers.read_lines(spark, folder))
    out = str(tmp_path / "out")
    writers.write_corrupt(corrupt, out, "r1")
    assert sorted(r[0] for r in readers.read_corrupt(spark, out, "r1").collect()) == CORRUPT


def test_cleaned_round_trip(spark, cleaned, tmp_path):
    out = str(tmp_path)
    writers.write_cleaned(cleaned, out, "r1")
    back = readers.read_cleaned(spark, out, "r1")
    assert back.schema == schema.CLEANED_SCHEMA
    assert rows(back) == rows(cleaned)


def test_days_of_odd_years_come_back(spark, tmp_path):
    times = ["0000-01-02 00:00:00", "-0044-03-15 12:00:00", "+12024-01-01 00:00:00"]
    frame = cleaned_events(raw_frame(spark, *[event(timestamp=t) for t in times]))
    writers.write_cleaned(frame, str(tmp_path), "r1")
    back = readers.read_cleaned(spark, str(tmp_path), "r1")
    as_text = [F.col(c).cast("string") for c in ("timestamp", "event_timestamp", "event_date")]
    assert rows(back.select(*as_text)) == rows(frame.select(*as_text))


def test_a_day_is_read_from_its_own_folder(spark, cleaned, tmp_path):
    writers.write_cleaned(cleaned, str(tmp_path), "r1")
    back = readers.read_cleaned(spark, str(tmp_path), "r1")
    one = back.where(F.col("event_date") == F.lit("2024-01-05").cast("date")).select("price")
    scan = plan(one)
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "ReadSchema: struct<price:double>" in scan


@pytest.mark.parametrize("adaptive, skew", [("true", "true"), ("true", "false"), ("false", "false")])
def test_a_large_day_is_many_files_and_a_small_one_is_one(spark, tmp_path, adaptive, skew):
    """In the same run, whatever adaptive execution may do."""
    days = {"2024-01-05": 60_000, "2024-01-06": 25_000, "2024-01-07": 9_000, "2024-01-08": 10, "2024-01-09": 1}
    day = F.element_at(
        F.filter(
            F.array(
                *(F.struct(F.lit(sum(list(days.values())[: i + 1])).alias("end"), F.lit(d).alias("day")) for i, d in enumerate(days))
            ),
            lambda x: x["end"] > F.col("id"),
        ),
        1,
    )["day"]
    times = F.concat(day, F.lit(" "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00"))
    df = cleaned_events(
        spark.range(0, sum(days.values()), 1, 8).select(
            F.col("id").cast("string").alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("session_id"),
            F.lit("click").alias("action"),
            times.alias("timestamp"),
            F.lit("N").alias("region"),
            F.lit("mobile").alias("device"),
            F.lit(5).alias("duration_sec"),
            F.sha2((F.col("id") + 1).cast("string"), 256).alias("product_id"),
            F.lit(1.0).alias("price"),
        )
    )
    settings = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": skew,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        writers.write_cleaned(df, str(tmp_path), "r1", events_per_file=10_000)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    back = readers.read_cleaned(spark, str(tmp_path), "r1")
    found = (
        back.groupBy(F.col("event_date").cast("string").alias("day"), F.input_file_name())
        .count()
        .groupBy("day")
        .agg(F.count("*").alias("files"), F.max("count").alias("most"), F.sum("count").alias("rows"))
        .collect()
    )
    assert {r.day: (r.files, r.rows) for r in found} == {
        day: (-(-rows_ // 10_000), rows_) for day, rows_ in days.items()
    }
    assert max(r.most for r in found) < 12_000


def test_days_are_counted_from_the_shuffle_of_the_deduplication(cleaned):
    df = writers.deal_by_day(cleaned, 10)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1 and final.count("Scan parquet") == 1
    assert "BroadcastHashJoin" in final


def test_more_buckets_than_tasks_lose_nothing(spark, cleaned, tmp_path):
    writers.write_cleaned(cleaned, str(tmp_path), "r1", events_per_file=2)
    back = readers.read_cleaned(spark, str(tmp_path), "r1")
    assert rows(back) == rows(cleaned)
    files = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert files <= 4


def test_reports_equal_aggregates(spark, cleaned, tmp_path):
    out = str(tmp_path)
    writers.write_aggregates(metrics.analyze(cleaned), out, "r1")
    writers.write_reports(spark, out, "r1")
    for name, columns in schema.AGGREGATE_SCHEMAS.items():
        written = readers.read_aggregate(spark, out, name, "r1")
        report = readers.read_report(spark, out, name, "r1")
        assert written.schema == columns and report.schema == columns
        assert rows(report) == rows(written)
        text = readers.read_report(spark, out, name, "r1", typed=False)
        assert {t for _, t in text.dtypes} == {"string"}


def parts_of(folder, name):
    return sorted((folder / "reports" / f"{name}_report" / "run_id=r1").glob("part-*.csv"))


@pytest.mark.parametrize("single_file", [True, False])
def test_a_report_is_ordered(spark, cleaned, tmp_path, single_file):
    out = str(tmp_path)
    writers.write_aggregates(metrics.analyze(cleaned), out, "r1")
    writers.write_reports(spark, out, "r1", single_file=single_file)
    for name in schema.AGGREGATE_SCHEMAS:
        parts = parts_of(tmp_path, name)
        assert len(parts) == 1  # adaptive execution merges what is small
        header, *lines = parts[0].read_text(encoding="utf-8").splitlines()
        assert header == ";".join(schema.AGGREGATE_SCHEMAS[name].names)
        wanted = readers.read_aggregate(spark, out, name, "r1")
        wanted = wanted.orderBy(*metrics.report_order(name))
        first = ["" if v is None else str(v) for v in wanted.first()]
        assert lines[0].split(";")[:2] == first[:2]
        assert len(lines) == wanted.count()


@pytest.mark.parametrize("single_file", [True, False])
def test_report_files_are_ordered_in_sequence(spark, cleaned, tmp_path, single_file):
    out, name = str(tmp_path), "activity_by_region_hour"
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        writers.write_aggregate(metrics.activity_by_region_hour(cleaned), out, name, "r1")
        written = readers.read_aggregate(spark, out, name, "r1")
        writers.write_report(written, out, name, "r1", single_file)
    finally:
        spark.conf.unset(key)
    parts = parts_of(tmp_path, name)
    assert (len(parts) == 1) == single_file
    lines = [line for p in parts for line in p.read_text(encoding="utf-8").splitlines()[1:]]
    keys = [(r, d, int(h)) for r, d, h, *_ in (line.split(";") for line in lines)]
    assert keys == sorted(keys) and len(keys) == written.count()


def test_small_and_large_reports_take_the_same_plan(spark, tmp_path, monkeypatch):
    counted = []
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: counted.append(self))
    for n in (0, 3, 3000):
        rows_ = spark.range(n).selectExpr("date_add(DATE'2024-01-01', int(id)) AS event_date", "id", "id", "double(id)")
        frame = rows_.toDF(*schema.AGGREGATE_SCHEMAS["daily_activity"].names)
        writers.write_report(frame, str(tmp_path / str(n)), "daily_activity", "r1")
    assert not counted


def test_large_reports_are_cut_into_files_read_by_a_task_each(spark, tmp_path):
    name = "daily_activity"
    days = spark.range(2500).selectExpr("date_add(DATE'2000-01-01', int(id * 7 % 2500))", "id", "id", "double(id)")
    frame = days.toDF(*schema.AGGREGATE_SCHEMAS[name].names)
    writers.write_report(frame, str(tmp_path), name, "r1", rows_per_file=400)
    parts = parts_of(tmp_path, name)
    lines = [p.read_text(encoding="utf-8").splitlines()[1:] for p in parts]
    assert len(parts) >= 7 and max(map(len, lines)) <= 400
    dates = [line.split(";")[0] for some in lines for line in some]
    assert dates == sorted(dates)
    key = "spark.sql.files.openCostInBytes"
    spark.conf.set(key, "128m")
    try:
        back = readers.read_report(spark, str(tmp_path), name, "r1")
        assert back.rdd.getNumPartitions() == len(parts)
        assert rows(back) == rows(frame)
    finally:
        spark.conf.unset(key)


def test_an_empty_report_has_a_header_or_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], schema.AGGREGATE_SCHEMAS["daily_activity"])
    writers.write_report(empty, str(tmp_path), "daily_activity", "r1")
    back = readers.read_report(spark, str(tmp_path), "daily_activity", "r1")
    assert back.schema == empty.schema and back.collect() == []


ODD_VALUES = ["a;b", ' "N" ', " pad ", "x,y", "two\nlines", "two\r\nlines", "one\rtwo", "back\\slash", 'q"', '\\"', "\\", "é"]


def test_report_keeps_odd_values(spark, tmp_path):
    out, name = str(tmp_path), "top_users"
    odd = [(v, v, 1, 2, 3.0, i) for i, v in enumerate(ODD_VALUES)]
    df = spark.createDataFrame(odd, schema.AGGREGATE_SCHEMAS[name])
    writers.write_report(df, out, name, "r1")
    assert rows(readers.read_report(spark, out, name, "r1")) == rows(df)


@pytest.mark.parametrize(
    "header",
    [
        HEADER,
        HEADER.upper(),
        HEADER.replace(",", ", "),
        " " + HEADER.replace(",", " , "),
        ",".join(f'"{name}"' for name in HEADER.split(",")),
        "\ufeff" + HEADER,
    ],
)
def test_header_lines_are_no_corrupt_records(spark, tmp_path, header):
    (tmp_path / "a.csv").write_text("\n".join([header, LINES["normal"], ""]), encoding="utf-8")
    valid, corrupt = readers.split_corrupt(readers.read_lines(spark, str(tmp_path)))
    assert corrupt.collect() == []
    assert valid.count() == readers.read_clickstream(spark, str(tmp_path)).count() == 1
    lines = readers.read_lines(spark, str(tmp_path))
    assert readers.parse_lines(lines).count() == 1


def test_writing_a_run_again_replaces_that_run_only(spark, tmp_path):
    out = str(tmp_path)
    first, second = (
        cleaned_events(raw_frame(spark, *[event(session_id=f"{i}") for i in range(n)]))
        for n in (3, 2)
    )
    writers.write_cleaned(first, out, "r1")
    writers.write_cleaned(first, out, "r2")
    writers.write_cleaned(second, out, "r2")
    counts = readers.read_cleaned(spark, out).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in counts} == {"r1": 3, "r2": 2}


def test_latest_run_of_a_dataset(spark, tmp_path):
    out = str(tmp_path)
    frame = cleaned_events(raw_frame(spark, event()))
    for run_id in ("20240101_000000", "20240103_000000", "20240102_000000"):
        writers.write_cleaned(frame, out, run_id)
    # The greatest run has no summary, so it is not finished.
    for run_id in ("20240101_000000", "20240102_000000"):
        writers.write_summary(quality.run_summary(metrics.user_activity(frame)), out, run_id)
    finished = readers.read_summary(spark, out)
    latest = readers.latest_run(readers.read_cleaned(spark, out), finished)
    assert [r.run_id for r in latest.collect()] == ["20240102_000000"]
    assert "PartitionFilters: [isnotnull(run_id" in plan(latest)


def test_run_ids_stay_text(spark, tmp_path):
    out = str(tmp_path)
    writers.write_cleaned(cleaned_events(raw_frame(spark, event())), out, "007")
    assert [r.run_id for r in readers.read_cleaned(spark, out).collect()] == ["007"]


@pytest.mark.parametrize("run_id", ["", "a/b", "a b", "12:30", "a=b"])
def test_run_ids_must_fit_into_a_path(run_id):
    with pytest.raises(ValueError):
        layout.run_path("o", run_id)


def test_paths():
    assert layout.run_path(layout.report_path("o", "n"), "r") == "o/reports/n_report/run_id=r"
