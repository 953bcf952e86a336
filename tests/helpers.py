"""Comparing frames by value, and looking at plans."""

from __future__ import annotations

from clickloom import schema

TESTDATA = "/root/testdata"


def rows(df) -> list[tuple]:
    """All rows, columns in name order, in a repeatable order."""
    return in_order(map(tuple, df.select(*sorted(df.columns)).collect()))


def in_order(tuples) -> list[tuple]:
    return sorted(tuples, key=lambda row: [(v is None, "" if v is None else str(v)) for v in row])


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def event(**changes) -> tuple:
    """A valid raw row with some columns changed."""
    row = {
        "user_id": "u",
        "session_id": "s",
        "action": "click",
        "timestamp": "2024-01-07 10:11:12",
        "region": "North",
        "device": "mobile",
        "duration_sec": 30,
        "product_id": "p",
        "price": 50.0,
    }
    assert set(changes) <= set(row)
    return tuple({**row, **changes}[c] for c in schema.RAW_SCHEMA.names)


def raw_frame(spark, *events):
    return spark.createDataFrame(list(events), schema.RAW_SCHEMA)
