"""Event time: strict parsing and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes that TIMESTAMP_FORMAT accepts: a four-digit year, a longer one with plus,
# or one with minus that is not zero. ``\z`` rather than ``$``, which would also accept
# a trailing line break.
_SHAPE = r"^(\d{4}|\+\d{5,6}|-(?!0+-)\d{4,6})-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def parse_event_time(text: Column | str = "timestamp") -> Column:
    """Zone-less timestamp of ``yyyy-MM-dd HH:mm:ss`` text, NULL if it is not one.

    The shape test keeps the strictness of the pattern (``2024-1-9 1:2:3`` is not a
    time) and ``try_cast`` turns impossible dates into NULL also under ANSI mode.
    Nothing passes through the session time zone, so an hour skipped by daylight
    saving is kept as written; the cast is also cheaper than the pattern formatter.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(_SHAPE), text.try_cast("timestamp_ntz"))


def time_features(event_time: Column | str = "event_timestamp") -> dict[str, Column]:
    """Calendar columns of an event time, ready for ``withColumns``."""
    return {
        "event_date": F.to_date(event_time),
        "event_hour": F.hour(event_time),
        "event_dayofweek": F.dayofweek(event_time),  # 1 = Sunday
    }
