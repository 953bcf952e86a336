"""Aggregates over cleaned events.

Every aggregate combines on the map side before its exchange. The ones with a distinct
count first shrink to one row per (group, user), so neither a very active user nor a
very large group ends up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.functions import mean, total, unsummed


def report_order(name: str) -> list[Column]:
    """Row order of an aggregate; no two rows share a place in it."""
    return {
        "activity_by_region_hour": [F.asc("region"), F.asc("event_date"), F.asc("event_hour")],
        "device_statistics": [
            F.asc("device"),
            F.desc("session_count"),
            F.asc("session_category"),
        ],
        "top_users": [F.asc("rank")],
        "daily_activity": [F.asc("event_date")],
    }[name]


def in_report_order(name: str, df: DataFrame) -> DataFrame:
    """An aggregate sorted for reading. A report is sorted as it is written."""
    return df.orderBy(*report_order(name))


def activity_by_region_hour(
    cleaned: DataFrame, exact_money: bool = True, ordered: bool = True
) -> DataFrame:
    """Events, users, mean duration and revenue per region, day and hour."""
    per_hour = cleaned.groupBy("region", "event_date", "event_hour").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.avg("duration_sec").alias("avg_duration"),
        total("price", exact_money).alias("total_revenue"),
        mean("price", exact_money).alias("avg_price"),
    )
    return in_report_order("activity_by_region_hour", per_hour) if ordered else per_hour


def device_statistics(cleaned: DataFrame, ordered: bool = True) -> DataFrame:
    """Events, mean duration and users per device and session category."""
    per_device = cleaned.groupBy("device", "session_category").agg(
        F.count("*").alias("session_count"),
        F.avg("duration_sec").alias("avg_duration"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    return in_report_order("device_statistics", per_device) if ordered else per_device


def user_activity(cleaned: DataFrame, exact_money: bool = True) -> DataFrame:
    """Events, time, money and days per user and region. ``total_sessions`` counts events.

    ``unsummed_prices`` counts the prices that exact money leaves out.
    """
    return cleaned.groupBy("user_id", "region").agg(
        F.count("*").alias("total_sessions"),
        F.sum("duration_sec").alias("total_time"),
        total("price", exact_money).alias("total_spent"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
        unsummed("price").alias("unsummed_prices"),
    )


def top_users(
    cleaned: DataFrame, exact_money: bool = True, limit: int = schema.TOP_USERS
) -> DataFrame:
    """The most active (user, region) pairs, ranked 1..limit without shared ranks."""
    return rank_users(user_activity(cleaned, exact_money), limit)


def rank_users(users: DataFrame, limit: int = schema.TOP_USERS) -> DataFrame:
    """:func:`top_users` from the rows of :func:`user_activity`.

    Ties are ordered by user and region, so the list is repeatable. Each task keeps
    its own best ``limit`` rows; the ranking window sees only the merged ``limit``.
    """
    by_activity = [F.desc("total_sessions"), F.asc("user_id"), F.asc("region")]
    facts = users.select("user_id", "region", "total_sessions", "total_time", "total_spent")
    rank = F.row_number().over(Window.orderBy(*by_activity))
    return facts.orderBy(*by_activity).limit(limit).withColumn("rank", rank.cast("long"))


def daily_activity(
    cleaned: DataFrame, exact_money: bool = True, ordered: bool = True
) -> DataFrame:
    """Events, users and revenue per day."""
    per_day = cleaned.groupBy("event_date").agg(
        F.count("*").alias("daily_events"),
        F.count_distinct("user_id").alias("daily_users"),
        total("price", exact_money).alias("daily_revenue"),
    )
    return in_report_order("daily_activity", per_day) if ordered else per_day


def analyze(
    cleaned: DataFrame, users: DataFrame | None = None, exact_money: bool = True
) -> dict[str, DataFrame]:
    """The four standard aggregates by name, all lazy and in no order.

    They are written as tables, and sorted once, when their reports are written; use
    :func:`in_report_order` to look at them. ``users`` are rows of :func:`user_activity`,
    where they are already at hand.
    """
    if users is None:
        users = user_activity(cleaned, exact_money)
    return {
        "activity_by_region_hour": activity_by_region_hour(cleaned, exact_money, False),
        "device_statistics": device_statistics(cleaned, False),
        "top_users": rank_users(users),
        "daily_activity": daily_activity(cleaned, exact_money, False),
    }


def region_rollup(activity: DataFrame) -> DataFrame:
    """Events per region, summed up from :func:`activity_by_region_hour`."""
    return (
        activity.groupBy("region")
        .agg(F.sum("total_events").alias("total_events"))
        .orderBy(F.desc("total_events"), F.asc("region"))
    )


def top_regions(activity: DataFrame, limit: int = schema.TOP_REGIONS) -> DataFrame:
    """The regions with most events."""
    return region_rollup(activity).limit(limit)


def recent_days(daily: DataFrame, limit: int = schema.RECENT_DAYS) -> DataFrame:
    """The latest days of :func:`daily_activity`, newest first."""
    return daily.orderBy(F.desc("event_date")).limit(limit)


def distinct_users(cleaned: DataFrame) -> DataFrame:
    """Every user id once."""
    return cleaned.select("user_id").distinct()


def distinct_regions(cleaned: DataFrame) -> DataFrame:
    """Every region once."""
    return cleaned.select("region").distinct()


def cleaned_sample(cleaned: DataFrame, limit: int = schema.CLEANED_SAMPLE_ROWS) -> DataFrame:
    """The earliest cleaned rows, in an order over all columns so it is repeatable."""
    order = ["event_timestamp", *(c for c in cleaned.columns if c != "event_timestamp")]
    return cleaned.orderBy(*order).limit(limit)


def daily_sample(daily: DataFrame, limit: int = schema.DAILY_SAMPLE_ROWS) -> DataFrame:
    """The first days of :func:`daily_activity`."""
    return daily.orderBy("event_date").limit(limit)
