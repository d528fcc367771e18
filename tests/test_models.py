"""Edge rows through the models."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from events_data import Events, products
from trailmart.operators import dimensions, experiment, facts, marts
from trailmart.operators.staging import stg_events


def staged(spark, events):
    return stg_events(events.frame(spark))


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_staging_normalises_and_filters(spark):
    events = (
        Events()
        .add("2024-03-03T23:59:59.5", " VIEW ", session="  ")
        .add("2024-03-04T00:00:00", "Cart", price=None, session=" s ")
        .add("2024-03-04T00:00:00", "signup")
    )
    rows = staged(spark, events).orderBy("event_id").collect()
    assert [(r.event_type, r.user_session) for r in rows] == [("view", None), ("cart", "s")]
    sunday, monday = rows
    assert (sunday.event_date, sunday.event_hour, sunday.event_day_of_week) == (datetime.date(2024, 3, 3), 23, 0)
    assert sunday.event_month == datetime.date(2024, 3, 1)
    assert (monday.event_day_of_week, monday.price) == (1, None)


@pytest.mark.parametrize(
    ("kinds", "label"),
    [
        ("view cart purchase", "view_cart_purchase"),
        ("purchase cart view", "view_cart_purchase"),
        ("view cart", "view_cart_no_purchase"),
        ("view purchase", "view_purchase_no_cart"),
        ("view", "view_only"),
        ("cart purchase", "cart_purchase_no_view"),
        ("purchase", "purchase_only"),
        ("cart", "other"),
    ],
)
def test_journeys(spark, kinds, label):
    events = Events()
    for kind in kinds.split():
        events.add("2024-03-03T10:00:00", kind)
    assert facts.fact_sessions(staged(spark, events)).first().journey_pattern == label


def test_sessions(spark):
    events = (
        Events()
        .add("2024-03-03T23:59:00", "view", user=9, session="night", product=1)
        .add("2024-03-04T00:00:30.25", "purchase", user=4, session="night", product=2, price="7.25")
        .add("2024-03-04T00:00:10", "cart", user=9, session="night", product=1)
        .add("2024-03-03T10:00:00", "purchase", session="unpriced", price=None)
        .add("2024-03-03T10:00:00", "view", session=None)
    )
    rows = by(facts.fact_sessions(staged(spark, events)), "user_session")
    assert set(rows) == {"night", "unpriced"}
    night = rows["night"]
    assert (night.user_id, night.events_in_session, night.unique_products_viewed) == (4, 3, 2)
    assert night.session_duration_minutes == pytest.approx(90.25 / 60)
    assert night.session_revenue == Decimal("7.25")
    assert rows["unpriced"].session_revenue is None


def test_funnel_counts_a_midnight_session_on_both_days(spark):
    events = (
        Events()
        .add("2024-03-03T23:59:00", "view", session="night")
        .add("2024-03-04T00:01:00", "cart", session="night")
        .add("2024-03-04T00:02:00", "cart", session=None, user=2)
    )
    rows = by(facts.fact_funnel_steps(staged(spark, events)), "event_date")
    first, second = rows[datetime.date(2024, 3, 3)], rows[datetime.date(2024, 3, 4)]
    assert (first.sessions, second.sessions) == (1, 1)
    assert (second.total_events, second.active_users, second.sessions_with_cart) == (2, 2, 1)
    # No views on the second day: rates over views are NULL, not an error.
    assert second.event_view_to_cart_rate is None and second.session_view_to_cart_rate is None
    assert first.event_view_to_cart_rate == 0
    assert second.event_cart_to_purchase_rate == 0


def test_calendar_fills_gaps_and_growth_does_not(spark):
    events = Events().add("2024-02-28T10:00:00", "view").add("2024-03-02T10:00:00", "purchase", price=None)
    clean = staged(spark, events)
    dates = dimensions.dim_date(clean)
    days = by(dates, "date_day")
    assert len(days) == 4
    leap = days[datetime.date(2024, 2, 29)]
    assert (leap.day_of_week_name, leap.month_name) == ("Thursday ", "February ")
    assert (leap.week_start_date, leap.quarter_start_date) == (datetime.date(2024, 2, 26), datetime.date(2024, 1, 1))
    assert [days[d].is_weekend for d in sorted(days)] == [0, 0, 0, 1]
    growth = by(
        marts.mart_growth_daily(facts.fact_funnel_steps(clean), facts.fact_conversions(clean), dates), "event_date"
    )
    assert set(growth) == {datetime.date(2024, 2, 28), datetime.date(2024, 3, 2)}
    quiet, unpriced = growth[datetime.date(2024, 2, 28)], growth[datetime.date(2024, 3, 2)]
    assert (quiet.purchase_events, quiet.total_revenue, quiet.avg_purchase_value) == (0, 0, 0)
    assert (unpriced.purchase_events, unpriced.total_revenue) == (1, 0)
    assert unpriced.purchase_events_per_session_pct == 100


def test_no_events_give_no_calendar(spark):
    assert dimensions.dim_date(staged(spark, Events())).count() == 0


def test_users_sharing_sessions(spark):
    events = (
        Events()
        .add("2024-03-03T10:00:00", "view", user=1, session="shared")
        .add("2024-03-03T10:01:00", "cart", user=2, session="shared")
        .add("2024-03-03T10:02:00", "purchase", user=3, session="own", price=None)
        .add("2024-03-03T10:03:00", "purchase", user=3, session="own", price="3.01")
        .add("2024-03-03T10:03:00", "purchase", user=3, session="own", price="3.00")
    )
    clean = staged(spark, events)
    rows = by(dimensions.dim_user(clean, facts.fact_sessions(clean)), "user_id")
    assert (rows[1].total_sessions, rows[1].session_count, rows[1].user_segment) == (1, 1, "carted_not_purchased")
    # All sessions of user 2 belong to user 1.
    assert (rows[2].total_sessions, rows[2].session_count, rows[2].user_segment) == (1, 0, "other")
    assert rows[2].avg_events_per_session == 0
    assert (rows[3].conversion_count, rows[3].total_revenue) == (3, Decimal("6.01"))
    # The mean is over priced purchases: 6.01 / 2 = 3.005 rounds up.
    assert rows[3].avg_purchase_value == Decimal("3.01")
    assert rows[3].user_segment == "purchaser"


def test_unmatched_and_unknown_products_stay_apart(spark):
    events = (
        Events()
        .add("2024-03-03T10:00:00", "purchase", product=1)
        .add("2024-03-03T10:00:00", "purchase", product=2)
        .add("2024-03-03T10:00:00", "purchase", product=3)
    )
    master = dimensions.dim_product(products(spark, [(1, " ", None), (3, "toys", "acme"), (None, "x", "y")]))
    rows = marts.mart_revenue_attribution(facts.fact_conversions(staged(spark, events)), master).collect()
    seen = {(r.category_code, r.brand, r.is_unknown_category, r.is_unknown_brand) for r in rows}
    assert seen == {("unknown", "unknown", 1, 1), ("unknown", "unknown", None, None), ("toys", "acme", 0, 0)}


def test_missing_revenue_sorts_first_in_top_rows(spark):
    events = (
        Events()
        .add("2024-03-03T10:00:00", "purchase", category=1, price=None)
        .add("2024-03-03T10:00:00", "purchase", category=2, price="9.00")
    )
    master = dimensions.dim_product(products(spark, []))
    mart = marts.mart_revenue_attribution(facts.fact_conversions(staged(spark, events)), master)
    assert [r.total_revenue for r in marts.top_attribution_rows(mart).collect()] == [None, Decimal("9.00")]


def summary(spark, rows):
    names = "experiment_name experiment_variant".split() + list(experiment.LIFTS)
    kinds = ", ".join(f"{n} {'string' if n.startswith('experiment') else 'decimal(18,2)'}" for n in names)
    cells = [("e", variant, *(Decimal(v) for v in values)) for variant, values in rows]
    return spark.createDataFrame(cells, kinds)


def test_lift_verdicts(spark):
    control = ["10.00", "8.00", "1.00", "1.00", "0.00", "1.00"]
    rows = [
        ("control", control),
        ("up", ["11.00", "9.00", "1.00", "1.00", "1.00", "0.50"]),
        ("down", ["9.00", "7.99", "1.00", "1.00", "1.00", "1.00"]),
        ("split", ["11.00", "7.00", "1.00", "1.00", "1.00", "1.00"]),
    ]
    result = by(experiment.lift_against_control(summary(spark, rows)), "experiment_variant")
    verdicts = {name: row.experiment_result_status for name, row in result.items()}
    assert verdicts == {
        "control": "baseline",
        "up": "positive_lift",
        "down": "negative_lift",
        "split": "mixed_result",
    }
    assert result["down"].revenue_per_user_lift_pct == Decimal("-0.13")
    # A control metric of zero has no lift.
    assert result["up"].session_cart_rate_lift_pct is None
    assert result["up"].session_purchase_rate_lift_pct == -50


def test_no_control_gives_no_lift(spark):
    result = experiment.lift_against_control(summary(spark, [("treatment", ["1.00"] * 6)])).first()
    assert result.experiment_result_status == "mixed_result"
    assert all(result[name] is None for name in experiment.LIFTS.values())


def test_assignment_is_stable_and_split_is_a_parameter(spark):
    users = spark.range(2000).select(F.col("id").alias("user_id"), F.current_date().alias("first_seen_date"))
    first = experiment.assign_variants(users)
    again = experiment.assign_variants(users.repartition(7))
    assert first.exceptAll(again).count() == 0
    shares = by(first.groupBy("experiment_variant").count(), "experiment_variant")
    assert 900 < shares["control"]["count"] < 1100
    assert first.filter("assignment_bucket not between 0 and 99").count() == 0
    small = experiment.assign_variants(users, "other", control_share=10)
    assert small.filter("experiment_variant = 'control' and assignment_bucket >= 10").count() == 0
