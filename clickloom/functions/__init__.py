"""Column expressions. All of them compile to JVM code; there are no Python UDFs."""

from clickloom.functions.categories import price_category, session_category
from clickloom.functions.money import mean, total, unsummed
from clickloom.functions.temporal import parse_event_time, time_features

__all__ = [
    "mean",
    "parse_event_time",
    "price_category",
    "session_category",
    "time_features",
    "total",
    "unsummed",
]
