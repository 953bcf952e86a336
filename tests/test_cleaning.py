from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.operators.cleaning import (
    cleaned_events,
    dedupe_events,
    enrich,
    fill_defaults,
    filter_valid,
)
from helpers import event, optimized, plan, raw_frame, rows


def test_dedupe_keeps_the_least_row_with_nulls_first(spark):
    df = raw_frame(
        spark,
        event(action="view", duration_sec=5),
        event(action="click", duration_sec=9),
        event(action="click", duration_sec=7),
        event(session_id="other"),
        event(session_id="other", action=None),
    )
    assert rows(dedupe_events(df)) == rows(
        raw_frame(spark, event(duration_sec=7), event(session_id="other", action=None))
    )


def test_missing_keys_equal_each_other(spark):
    gone = {"user_id": None, "session_id": None, "timestamp": None}
    assert dedupe_events(raw_frame(spark, event(**gone), event(**gone))).count() == 1


def test_empty_and_missing_user_are_different_keys(spark):
    df = raw_frame(spark, event(user_id=None), event(user_id=""))
    assert dedupe_events(df).count() == 2


def test_dedupe_is_idempotent_and_keeps_the_columns(raw):
    once = dedupe_events(raw)
    assert once.columns == schema.RAW_SCHEMA.names
    assert rows(dedupe_events(once)) == rows(once)


def test_fill_replaces_nulls_only(spark):
    df = raw_frame(
        spark,
        event(user_id=None, region=None, device=None, session_id=None, action=None),
        event(user_id="", region="", device=""),
    )
    assert rows(fill_defaults(df)) == rows(
        raw_frame(
            spark,
            event(
                user_id="unknown_user",
                region="Неизвестно",
                device="unknown",
                session_id=None,
                action=None,
            ),
            event(user_id="", region="", device=""),
        )
    )


def test_filter(spark):
    kept = [
        event(duration_sec=1, price=0.0),
        event(price=math.nan),
        event(device="smart_watch", action="unknown_action"),
        event(session_id=None, product_id=None, action=None),
    ]
    dropped = [
        event(user_id=""),
        event(user_id=None),
        event(duration_sec=0),
        event(duration_sec=-1),
        event(duration_sec=None),
        event(price=-0.01),
        event(price=None),
        event(timestamp="2024-13-45 25:61:61"),
        event(timestamp=None),
    ]
    df = raw_frame(spark, *kept, *dropped)
    assert rows(filter_valid(df).drop("price")) == rows(raw_frame(spark, *kept).drop("price"))


def test_missing_user_is_kept_and_empty_user_is_dropped(spark):
    df = cleaned_events(raw_frame(spark, event(user_id=None), event(user_id="")))
    assert [r.user_id for r in df.collect()] == ["unknown_user"]


def test_invalid_duplicate_displaces_a_valid_one(spark):
    df = raw_frame(spark, event(duration_sec=30), event(duration_sec=-1))
    assert cleaned_events(df).count() == 0


def test_enrich_columns(spark):
    df = enrich(raw_frame(spark, event()))
    assert df.columns == [
        *schema.RAW_SCHEMA.names,
        "event_timestamp",
        "event_date",
        "event_hour",
        "event_dayofweek",
        "session_category",
        "price_category",
    ]
    assert {f.name: f.dataType for f in df.schema} == {
        f.name: f.dataType for f in schema.CLEANED_SCHEMA
    }


def test_result_does_not_depend_on_partitioning(raw, cleaned):
    wanted = rows(cleaned)
    for n in (1, 3, 17):
        assert rows(cleaned_events(raw.repartition(n).orderBy(F.rand(n)))) == wanted


_texts = st.sampled_from([None, "", "a", "b"])


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.builds(
            event,
            user_id=_texts,
            session_id=_texts,
            action=_texts,
            timestamp=st.sampled_from([None, "2024-01-07 10:11:12", "2024-13-45 25:61:61"]),
            region=_texts,
            device=_texts,
            duration_sec=st.sampled_from([None, -1, 0, 1, 60]),
            price=st.sampled_from([None, -1.0, 0.0, 2.5]),
        ),
        max_size=60,
    )
)
def test_cleaning_against_brute_force(spark, events):
    names = schema.RAW_SCHEMA.names
    keys = [names.index(c) for c in schema.DEDUPE_KEYS]
    rest = [i for i in range(len(names)) if i not in keys]
    survivors = {}
    for row in events:
        key = tuple(row[i] for i in keys)
        order = [(row[i] is not None, row[i]) for i in rest]
        if key not in survivors or order < survivors[key][0]:
            survivors[key] = (order, row)
    wanted = []
    for _, row in survivors.values():
        r = dict(zip(names, row))
        for column, value in schema.FILL_DEFAULTS.items():
            r[column] = value if r[column] is None else r[column]
        if (
            r["user_id"] != ""
            and (r["duration_sec"] or 0) > 0
            and r["price"] is not None
            and r["price"] >= 0
            and r["timestamp"] == "2024-01-07 10:11:12"
        ):
            wanted.append(tuple(r[c] for c in names))
    got = cleaned_events(raw_frame(spark, *events)).select(*names)
    assert rows(got) == rows(raw_frame(spark, *wanted))


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    """A third of all rows are copies of one event; only partial results are shuffled."""
    df = spark.range(0, 300_000, 1, 8).select(
        *(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
            .alias(c)
            if c == "session_id"
            else F.lit(v).cast(schema.RAW_SCHEMA[c].dataType).alias(c)
            for c, v in zip(schema.RAW_SCHEMA.names, event())
        )
    )
    result = dedupe_events(df)
    assert result.count() == 200_001
    assert "partial_min" in plan(result)


def test_one_shuffle_and_early_filters(cleaned):
    text = plan(cleaned)
    assert text.count("Exchange") == 1
    below = optimized(cleaned).split("Aggregate [session_id")[1]
    # Tests on dedupe keys run before the shuffle, the others after it.
    assert "Filter" in below and "RLIKE" in below.replace("rlike", "RLIKE")
    assert "duration_sec" not in below.split("Filter")[1].split("\n")[0]
