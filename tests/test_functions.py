from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.functions import (
    mean,
    parse_event_time,
    price_category,
    session_category,
    time_features,
    total,
)

TIMES = [
    "2024-01-07 10:11:12",
    "2024-02-29 00:00:00",
    "0000-01-01 00:00:00",
    "9999-12-31 23:59:59",
    "1582-10-10 00:00:00",
    "+12024-01-01 00:00:00",
    "-2024-01-01 00:00:00",
]
NOT_TIMES = [
    "2024-13-45 25:61:61",
    "2024-1-9 1:2:3",
    "2023-02-29 00:00:00",
    "2024-04-31 01:01:01",
    "2024-00-10 00:00:00",
    "2024-01-00 00:00:00",
    "2024-01-01 24:00:00",
    "2024-01-01 23:59:60",
    "12024-01-01 00:00:00",
    " 2024-01-01 00:00:00",
    "2024-01-01 00:00:00 ",
    "2024-01-01 00:00:00\n",
    "2024-01-01 00:00:00Z",
    "2024-01-01 00:00:00 UTC",
    "2024-01-01 00:00:00.5",
    "2024-01-01T00:00:00",
    "2024-01-01 00:00",
    "2024-01-01",
    "２０２４-01-01 00:00:00",
    "",
    None,
]


def _disagreements(spark, texts) -> list:
    """Texts for which the strict pattern formatter gives another answer."""
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    formatter = F.try_to_timestamp("timestamp", F.lit(schema.TIMESTAMP_FORMAT))
    same = parse_event_time().eqNullSafe(formatter.cast("timestamp_ntz"))
    return df.where(~same).collect()


def test_parse_accepts_and_rejects(spark):
    df = spark.createDataFrame([(t,) for t in TIMES + NOT_TIMES], "timestamp string")
    parsed = df.where(parse_event_time().isNotNull()).collect()
    assert [r.timestamp for r in parsed] == TIMES
    assert _disagreements(spark, TIMES + NOT_TIMES) == []


def test_parse_agrees_with_the_pattern_formatter(spark):
    rnd = random.Random(7)

    def field(width, top):
        return rnd.choice([f"{rnd.randrange(top):0{width}d}"] * 15 + [str(rnd.randrange(10))])

    def text():
        year, month, day = field(4, 10000), field(2, 14), field(2, 33)
        hour, minute, second = field(2, 26), field(2, 62), field(2, 62)
        year = rnd.choice([year] * 19 + ["0000"])
        sign = rnd.choice([""] * 9 + ["+", "-", " ", "1", "+1", "+0", "-0", "+00", "-00", "-1"])
        end = rnd.choice([""] * 9 + [" ", "Z", ".0"])
        return f"{sign}{year}-{month}-{day} {hour}:{minute}:{second}{end}"

    assert _disagreements(spark, [text() for _ in range(20_000)]) == []


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_time_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day is skipped by daylight saving in Los Angeles.
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "timestamp string")
        df = df.select(parse_event_time().alias("event_timestamp")).withColumns(time_features())
        row = df.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert str(row.event_timestamp) == "2024-03-10 02:30:00"
    assert (str(row.event_date), row.event_hour, row.event_dayofweek) == ("2024-03-10", 2, 1)


def test_day_of_week_starts_on_sunday(spark):
    df = spark.createDataFrame(
        [("2024-01-06 00:00:00",), ("2024-01-07 23:59:59",)], "timestamp string"
    )
    df = df.select(time_features(parse_event_time())["event_dayofweek"].alias("d"))
    assert [r.d for r in df.collect()] == [7, 1]


def test_session_category_edges(spark):
    df = spark.createDataFrame([(n,) for n in (1, 59, 60, 300, 301, None)], "duration_sec int")
    got = [r[0] for r in df.select(session_category()).collect()]
    assert got == ["short", "short", "medium", "medium", "long", "long"]


def test_price_category_edges(spark):
    prices = (0.0, 99.99, 100.0, 500.0, 500.01, math.nan, None)
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = [r[0] for r in df.select(price_category()).collect()]
    assert got == ["low", "low", "medium", "medium", "high", "high", "high"]


def test_money_as_double_and_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "price double").repartition(5)
    exact = df.agg(total("price"), mean("price")).first()
    assert tuple(exact) == (1.0, 0.1)
    assert df.agg(total("price", exact=False)).first()[0] == pytest.approx(1.0)
    assert df.agg(mean("price", exact=False)).first()[0] == pytest.approx(0.1)


def test_nan_poisons_doubles_but_is_left_out_of_exact_money(spark):
    df = spark.createDataFrame([(2.5,), (math.nan,)], "price double")
    assert math.isnan(df.agg(total("price", exact=False)).first()[0])
    assert tuple(df.agg(total("price", True), mean("price", True)).first()) == (2.5, 2.5)
    only_nan = df.where(F.isnan("price"))
    assert tuple(only_nan.agg(total("price", True), mean("price", True)).first()) == (None, None)
