"""Three-way buckets for session length and price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom import schema


def _bucket(value: Column | str, below, up_to, names: tuple[str, str, str]) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    first, second, rest = names
    return F.when(value < below, first).when(value <= up_to, second).otherwise(rest)


def session_category(duration: Column | str = "duration_sec") -> Column:
    """short, medium or long. A NULL duration counts as long."""
    return _bucket(
        duration,
        schema.SHORT_BELOW_SEC,
        schema.MEDIUM_UP_TO_SEC,
        ("short", "medium", "long"),
    )


def price_category(price: Column | str = "price") -> Column:
    """low, medium or high. A NULL price counts as high."""
    return _bucket(
        price,
        schema.LOW_BELOW_PRICE,
        schema.MEDIUM_UP_TO_PRICE,
        ("low", "medium", "high"),
    )
