"""From raw rows to cleaned, enriched events.

The order matters and is kept: duplicates are resolved on the raw values, missing
values are filled next, and only then are rows rejected. So a missing user id becomes
``unknown_user`` and stays, while an empty string (which CSV input cannot produce) is
dropped, and a duplicate that is itself invalid can displace a valid one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.functions import (
    parse_event_time,
    price_category,
    session_category,
    time_features,
)


def dedupe_events(df: DataFrame) -> DataFrame:
    """One row per (user_id, session_id, timestamp): the least by the other columns.

    Missing keys equal each other, and NULL is less than any value. ``min`` of a
    struct is combined on the map side, so a group of copies leaves each task as a
    single row however large it is, and a rerun of a lost task picks the same row.

    The grouping starts with session_id: rows are sorted by the grouping columns
    before and after the exchange, and the most selective one first makes most
    comparisons end in the sort prefix.
    """
    rest = [c for c in df.columns if c not in schema.DEDUPE_KEYS]
    return (
        df.groupBy("session_id", "timestamp", "user_id")
        .agg(F.min(F.struct(*rest)).alias("_survivor"))
        .select(
            *(c if c in schema.DEDUPE_KEYS else F.col("_survivor")[c].alias(c) for c in df.columns)
        )
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    """Replace missing region, device and user_id; empty strings are not missing."""
    return df.fillna(schema.FILL_DEFAULTS)


def filter_valid(df: DataFrame) -> DataFrame:
    """Keep rows with a user, a positive duration, a non-negative price and a time.

    A NULL fails its test. A NaN price passes, as NaN is the greatest double.
    The tests on user_id and timestamp are on dedupe keys, so the optimizer moves them
    below :func:`dedupe_events`, ahead of its shuffle; the other two must stay above.
    """
    return df.where(
        (F.col("user_id") != "")
        & (F.col("duration_sec") > 0)
        & (F.col("price") >= 0)
        & parse_event_time("timestamp").isNotNull()
    )


def enrich(df: DataFrame) -> DataFrame:
    """Add event_timestamp, its calendar features and the two categories."""
    return df.withColumn("event_timestamp", parse_event_time("timestamp")).withColumns(
        {
            **time_features("event_timestamp"),
            "session_category": session_category("duration_sec"),
            "price_category": price_category("price"),
        }
    )


def cleaned_events(raw: DataFrame) -> DataFrame:
    """The whole cleaning step: dedupe, fill, reject, enrich."""
    return (
        raw.transform(dedupe_events)
        .transform(fill_defaults)
        .transform(filter_valid)
        .transform(enrich)
    )
