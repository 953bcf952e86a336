"""Raw clickstream rows made from an ``events`` table, defects and copies included.

Every event of the table becomes one row. Which rows carry which defect follows from
``event_id``, so the same rows come out of Spark and of any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema

# --- Fixed values: the defects and the event_id remainder that gets them ------------

DEFECT_CYCLE = 80
MISSING_USER = 0
EMPTY_USER = 1
MISSING_SESSION = 10
UNKNOWN_ACTION = 20
BAD_TIMESTAMP = 30
MISSING_REGION = 40
UNKNOWN_DEVICE = 50
MISSING_DEVICE = 51
NEGATIVE_DURATION = 60
MISSING_DURATION = 61
NEGATIVE_PRICE = 70
MISSING_PRICE = 71

COPY_CYCLE = 50
EXACT_COPY = 7
CONFLICTING_COPY = 9

MALFORMED_CYCLE = 40
EXTRA_CELL = 3
SHORT_LINE = 4
TEXT_DURATION = 5

BAD_TIMESTAMP_TEXT = "2024-13-45 25:61:61"

DEVICES = ("mobile", "desktop", "tablet")
FIRST_PRODUCT = 1000
PRODUCTS = 9000
REGIONS = 8

#: A fraction of a second, which the raw format does not have.
FRACTION = r"\.\d+$"


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table; its schema is declared, so no file is opened to plan a query."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def inject_defects(events: DataFrame) -> DataFrame:
    """Raw rows, one per event, keeping ``event_id``."""
    event = F.col("event_id")
    remainder = event % DEFECT_CYCLE

    def defect(at: int, value) -> Column:
        return F.when(remainder == at, F.lit(value))

    device = F.get(F.array(*map(F.lit, DEVICES)), (event % len(DEVICES)).cast("int"))
    product = F.concat(F.lit("prod_"), (FIRST_PRODUCT + event % PRODUCTS).cast("string"))
    return events.select(
        "event_id",
        defect(MISSING_USER, None)
        .when(remainder == EMPTY_USER, "")
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        defect(MISSING_SESSION, None)
        .otherwise(F.concat(F.lit("sess_"), event.cast("string")))
        .alias("session_id"),
        defect(UNKNOWN_ACTION, "unknown_action").otherwise(F.col("event_type")).alias("action"),
        defect(BAD_TIMESTAMP, BAD_TIMESTAMP_TEXT)
        .otherwise(F.regexp_replace(F.col("ts").cast("string"), FRACTION, ""))
        .alias("timestamp"),
        defect(MISSING_REGION, None)
        .otherwise(F.concat(F.lit("region_"), (F.col("user_id") % REGIONS).cast("string")))
        .alias("region"),
        defect(UNKNOWN_DEVICE, "smart_watch")
        .when(remainder == MISSING_DEVICE, None)
        .otherwise(device)
        .alias("device"),
        defect(NEGATIVE_DURATION, -17)
        .when(remainder == MISSING_DURATION, None)
        .otherwise((1 + event * 37 % 600).cast("int"))
        .alias("duration_sec"),
        product.alias("product_id"),
        defect(NEGATIVE_PRICE, -10.5)
        .when(remainder == MISSING_PRICE, None)
        .otherwise(F.col("value") * 2)
        .alias("price"),
    )


def deliver_twice(rows: DataFrame) -> DataFrame:
    """Repeat some rows: exactly, or with a negative duration in the second copy.

    The second kind is the one that wins deduplication and is then rejected.
    """
    remainder = F.col("event_id") % COPY_CYCLE
    once, again, spoilt = F.lit("once"), F.lit("again"), F.lit("spoilt")
    copies = (
        F.when(remainder == EXACT_COPY, F.array(once, again))
        .when(remainder == CONFLICTING_COPY, F.array(once, spoilt))
        .otherwise(F.array(once))
    )
    return (
        rows.withColumn("copy", F.explode(copies))
        .withColumn(
            "duration_sec", F.when(F.col("copy") == "spoilt", -1).otherwise(F.col("duration_sec"))
        )
        .drop("copy")
    )


def clickstream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw clickstream table in one scan of ``events``."""
    rows = read_events(spark, sf_dir).transform(inject_defects).transform(deliver_twice)
    return rows.select(*schema.RAW_SCHEMA.names)


def clickstream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as CSV lines, some of them malformed."""
    rows = read_events(spark, sf_dir).transform(inject_defects).transform(deliver_twice)
    remainder = F.col("event_id") % MALFORMED_CYCLE
    cells = [
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.RAW_SCHEMA.names
    ]
    duration = schema.RAW_SCHEMA.names.index("duration_sec")
    text_duration = [*cells[:duration], F.lit("abc"), *cells[duration + 1 :]]
    return rows.select(
        F.when(remainder == EXTRA_CELL, F.concat_ws(",", *cells, F.lit("EXTRA")))
        .when(remainder == SHORT_LINE, F.concat_ws(",", *cells[:5]))
        .when(remainder == TEXT_DURATION, F.concat_ws(",", *text_duration))
        .otherwise(F.concat_ws(",", *cells))
        .alias("value")
    )
