from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import metrics, quality
from clickloom.operators.cleaning import cleaned_events
from helpers import event, plan, raw_frame, rows


def test_measures_count_every_event_once(cleaned):
    n = cleaned.count()
    results = metrics.analyze(cleaned)
    for name, measure in [
        ("daily_activity", "daily_events"),
        ("activity_by_region_hour", "total_events"),
        ("device_statistics", "session_count"),
    ]:
        assert results[name].agg(F.sum(measure)).first()[0] == n
    assert metrics.user_activity(cleaned).agg(F.sum("total_sessions")).first()[0] == n
    assert quality.run_summary(metrics.user_activity(cleaned)).first().cleaned_rows == n


def test_double_money_is_close_to_exact_money(cleaned):
    for operator, columns in [
        (metrics.activity_by_region_hour, ["total_revenue", "avg_price"]),
        (metrics.user_activity, ["total_spent"]),
        (metrics.daily_activity, ["daily_revenue"]),
    ]:
        keys = [c for c in operator(cleaned).columns if c not in columns]
        rounded, exact = (
            {
                tuple(r[k] for k in keys): [r[c] for c in columns]
                for r in operator(cleaned, exact_money=e).collect()
            }
            for e in (False, True)
        )
        assert rounded.keys() == exact.keys()
        for key, values in exact.items():
            assert rounded[key] == pytest.approx(values)


def test_exact_results_do_not_depend_on_partitioning(raw, cleaned):
    wanted = {n: rows(df) for n, df in metrics.analyze(cleaned).items()}
    again = cleaned_events(raw.orderBy(F.rand(7)).repartition(13))
    for name, df in metrics.analyze(again).items():
        assert rows(df) == wanted[name]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.builds(
            event,
            user_id=st.sampled_from(["a", "b", "c", None]),
            session_id=st.integers(0, 10**9).map(str),
            timestamp=st.sampled_from(
                ["2024-01-07 10:11:12", "2024-01-07 10:59:59", "2024-01-08 00:00:00"]
            ),
            region=st.sampled_from(["N", "S", None]),
            device=st.sampled_from(["mobile", None]),
            duration_sec=st.sampled_from([1, 59, 60, 300, 301]),
            price=st.sampled_from([0.0, 0.1, 99.99, 500.01]),
        ),
        max_size=50,
        unique_by=lambda row: row[1],
    )
)
def test_metrics_against_brute_force(spark, events):
    cleaned = cleaned_events(raw_frame(spark, *events))
    names = cleaned.columns
    groups = {"hour": {}, "device": {}, "user": {}, "day": {}}
    for values in cleaned.collect():
        r = dict(zip(names, values))
        for kind, key in [
            ("hour", (r["region"], r["event_date"], r["event_hour"])),
            ("device", (r["device"], r["session_category"])),
            ("user", (r["user_id"], r["region"])),
            ("day", (r["event_date"],)),
        ]:
            groups[kind].setdefault(key, []).append(r)

    def users(rs):
        return len({r["user_id"] for r in rs})

    def spent(rs):
        return float(sum(Decimal(str(r["price"])) for r in rs))

    def seconds(rs):
        return sum(r["duration_sec"] for r in rs)

    results = metrics.analyze(cleaned)
    assert {tuple(r) for r in results["activity_by_region_hour"].collect()} == {
        (*k, len(rs), users(rs), seconds(rs) / len(rs), spent(rs), spent(rs) / len(rs))
        for k, rs in groups["hour"].items()
    }
    assert {tuple(r) for r in results["device_statistics"].collect()} == {
        (*k, len(rs), seconds(rs) / len(rs), users(rs)) for k, rs in groups["device"].items()
    }
    assert {tuple(r) for r in results["daily_activity"].collect()} == {
        (*k, len(rs), users(rs), spent(rs)) for k, rs in groups["day"].items()
    }
    best = sorted(groups["user"].items(), key=lambda kv: (-len(kv[1]), kv[0]))
    assert [tuple(r) for r in results["top_users"].collect()] == [
        (*k, len(rs), seconds(rs), spent(rs), n + 1) for n, (k, rs) in enumerate(best)
    ]


def test_top_users_ranks_ties_by_user_and_region(spark):
    events = [
        event(user_id=u, region=r, session_id=f"{u}{r}{i}")
        for u, r, n in [("b", "N", 2), ("a", "S", 2), ("a", "N", 2), ("z", "N", 3), ("c", "N", 1)]
        for i in range(n)
    ]
    cleaned = cleaned_events(raw_frame(spark, *events).repartition(4))
    got = [(r["rank"], r.user_id, r.region) for r in metrics.top_users(cleaned, limit=4).collect()]
    assert got == [(1, "z", "N"), (2, "a", "N"), (3, "a", "S"), (4, "b", "N")]


def test_rows_come_in_report_order(cleaned):
    activity = metrics.activity_by_region_hour(cleaned).collect()
    assert activity == sorted(activity, key=lambda r: (r.region, r.event_date, r.event_hour))
    devices = metrics.device_statistics(cleaned).collect()
    assert devices == sorted(devices, key=lambda r: (r.device, -r.session_count))
    daily = metrics.daily_activity(cleaned).collect()
    assert daily == sorted(daily, key=lambda r: r.event_date)
    ranks = [r["rank"] for r in metrics.top_users(cleaned).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    recent = metrics.recent_days(metrics.daily_activity(cleaned)).collect()
    assert recent == daily[::-1][:5]


def test_top_regions_is_the_head_of_the_rollup(cleaned):
    activity = metrics.activity_by_region_hour(cleaned)
    assert metrics.top_regions(activity).collect() == metrics.region_rollup(activity).collect()[:5]


def test_plans(cleaned):
    top = plan(metrics.top_users(cleaned))
    assert "TakeOrderedAndProject(limit=100" in top
    assert top.index("Window") < top.index("TakeOrderedAndProject")
    # Groups are combined before each exchange, down to one row per group and user.
    activity = plan(metrics.activity_by_region_hour(cleaned))
    assert "partial_count(1)" in activity and "partial_count(distinct user_id" in activity
    assert "Expand" not in activity
    for df in metrics.analyze(cleaned).values():
        assert "Python" not in plan(df)


def test_summary_counts_pairs_before_copying_rows_per_distinct_column(cleaned):
    text = plan(quality.run_summary(metrics.user_activity(cleaned)))
    assert text.index("Expand") < text.index("partial_min(event_date")


def test_profile_does_not_sort_its_input(raw):
    text = plan(quality.raw_profile(raw))
    assert "HashAggregate(keys=[user_id" in text
    assert "Sort [" not in text


def test_profile_of_an_empty_table(spark):
    row = quality.raw_profile(raw_frame(spark)).first()
    assert (row.total_rows, row.unique_users, row.blank_user_ids) == (0, 0, 0)
    assert row.min_timestamp is None


def test_profile_counts(spark):
    df = raw_frame(
        spark,
        event(),
        event(user_id="", duration_sec=-1, timestamp="2024-13-45 25:61:61"),
        event(user_id=None, region=None, price=float("nan"), duration_sec=None),
    )
    assert quality.raw_profile(df).first().asDict() == {
        "total_rows": 3,
        "unique_users": 2,
        "unique_regions": 1,
        "min_timestamp": "2024-01-07 10:11:12",
        "max_timestamp": "2024-13-45 25:61:61",
        "blank_user_ids": 2,
        "negative_durations": 1,
        "nan_prices": 1,
        "unsummed_prices": 1,
    }


def test_money_leaves_nothing_out_in_silence(spark):
    prices = [1e17, 2.0, float("inf"), 0.004, 0.004, float("nan"), 1e18, None]
    events = [event(session_id=str(i), price=p) for i, p in enumerate(prices)]
    cleaned = cleaned_events(raw_frame(spark, *events))
    day = metrics.daily_activity(cleaned).first()
    exact = Decimal(10**17) + Decimal("2.008")
    assert day.daily_events == 7 and day.daily_revenue == float(exact)
    hour = metrics.activity_by_region_hour(cleaned).first()
    assert hour.avg_price == float(exact) / 4
    assert quality.run_summary(metrics.user_activity(cleaned)).first().unsummed_prices == 3
    assert quality.raw_profile(raw_frame(spark, *events)).first().unsummed_prices == 3
