"""Every registered query against its SQL, by value and by type."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from clickloom.fixtures.oracle import oracle_sql
from clickloom.fixtures.queries import queries
from helpers import TESTDATA, in_order, rows

SQL_TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}
NAMES = sorted(queries())


def expected(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    result = con.sql(sql)
    types = dict(zip(result.columns, map(str, result.types)))
    columns = ", ".join(f'"{c}"' for c in sorted(result.columns))
    return types, in_order(con.sql(f"SELECT {columns} FROM ({sql})").fetchall())


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(contract.queries())
    assert set(oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_oracle(spark, name, scale):
    sf_dir = f"{TESTDATA}/{scale}"
    types, wanted = expected(contract.oracle_sql()[name], sf_dir)
    df = contract.queries()[name](spark, sf_dir)
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    assert rows(df) == wanted


def test_entry_has_rows_and_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert contract.entry(spark).schema == df.schema


@pytest.mark.parametrize(
    "name, count",
    [
        ("clickstream_raw", 10_400),
        ("dedupe_events", 10_000),
        ("cleaned_events", 9_050),
        ("activity_by_region_hour", 4_652),
        ("device_statistics", 15),
        ("top_users", 100),
        ("daily_activity", 30),
    ],
)
def test_known_row_counts(spark, name, count):
    assert contract.queries()[name](spark, f"{TESTDATA}/sf0.01").count() == count


def test_known_fill_counts(spark):
    cleaned = contract.queries()["cleaned_events"](spark, f"{TESTDATA}/sf0.01")
    for column, value in [
        ("user_id", "unknown_user"),
        ("region", "Неизвестно"),
        ("device", "smart_watch"),
        ("device", "unknown"),
    ]:
        assert cleaned.where(cleaned[column] == value).count() == 125
    categories = cleaned.select("session_category", "price_category").distinct()
    assert categories.count() == 9
