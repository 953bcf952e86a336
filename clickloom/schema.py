"""Column layouts and fixed values of the clickstream data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: results depend on these literals -------------------------------

#: A repeated (user, session, time) triple is the same event delivered again.
DEDUPE_KEYS = ("user_id", "session_id", "timestamp")

#: What a missing value becomes. Columns not named here stay NULL.
FILL_DEFAULTS = {
    "region": "Неизвестно",
    "device": "unknown",
    "user_id": "unknown_user",
}

#: The only accepted form of the raw ``timestamp`` text.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: Seconds: below the first edge is short, up to and including the second is medium.
SHORT_BELOW_SEC = 60
MEDIUM_UP_TO_SEC = 300

#: Price: below the first edge is low, up to and including the second is medium.
LOW_BELOW_PRICE = 100
MEDIUM_UP_TO_PRICE = 500

TOP_USERS = 100
TOP_REGIONS = 5
RECENT_DAYS = 5
CLEANED_SAMPLE_ROWS = 5
DAILY_SAMPLE_ROWS = 3

CORRUPT_COLUMN = "_corrupt_record"
REPORT_DELIMITER = ";"

# --- Fixed values: row layouts ------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)

#: Cleaned rows in the order they come back from disk: the partition column is last.
CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("event_dayofweek", T.IntegerType()),
        T.StructField("session_category", T.StringType()),
        T.StructField("price_category", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

AGGREGATE_SCHEMAS = {
    "activity_by_region_hour": T.StructType(
        [
            T.StructField("region", T.StringType()),
            T.StructField("event_date", T.DateType()),
            T.StructField("event_hour", T.IntegerType()),
            T.StructField("total_events", T.LongType()),
            T.StructField("unique_users", T.LongType()),
            T.StructField("avg_duration", T.DoubleType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("avg_price", T.DoubleType()),
        ]
    ),
    "device_statistics": T.StructType(
        [
            T.StructField("device", T.StringType()),
            T.StructField("session_category", T.StringType()),
            T.StructField("session_count", T.LongType()),
            T.StructField("avg_duration", T.DoubleType()),
            T.StructField("unique_users", T.LongType()),
        ]
    ),
    "top_users": T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("total_sessions", T.LongType()),
            T.StructField("total_time", T.LongType()),
            T.StructField("total_spent", T.DoubleType()),
            T.StructField("rank", T.LongType()),
        ]
    ),
    "daily_activity": T.StructType(
        [
            T.StructField("event_date", T.DateType()),
            T.StructField("daily_events", T.LongType()),
            T.StructField("daily_users", T.LongType()),
            T.StructField("daily_revenue", T.DoubleType()),
        ]
    ),
}

#: Facts per (user, region), from which a run takes its top users and its summary.
USER_ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("total_sessions", T.LongType()),
        T.StructField("total_time", T.LongType()),
        T.StructField("total_spent", T.DoubleType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("unsummed_prices", T.LongType()),
    ]
)

#: One row per run. Input counts are NULL where only cleaned events were given.
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("raw_rows", T.LongType()),
        T.StructField("valid_rows", T.LongType()),
        T.StructField("corrupt_rows", T.LongType()),
        T.StructField("cleaned_rows", T.LongType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("min_date", T.DateType()),
        T.StructField("max_date", T.DateType()),
        T.StructField("distinct_users", T.LongType()),
        T.StructField("distinct_regions", T.LongType()),
        T.StructField("unsummed_prices", T.LongType()),
    ]
)
