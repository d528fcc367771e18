"""Calendar, product and user dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.functions.calendar import calendar_columns
from trailmart.functions.rates import mean_minutes, micros, ratio, sum_micros
from trailmart.functions.text import known_or_unknown
from trailmart.operators.facts import event_counts
from trailmart.schemas import EVENT_TYPES, TOTAL, UNKNOWN


def dim_date(events: DataFrame) -> DataFrame:
    """Every day between the first and the last event, days without events included.

    The bounds are one aggregated row that is expanded in place: one scan, nothing
    returns to the driver.
    """
    bounds = events.agg(F.expr("to_date(min(event_time)) as first"), F.expr("to_date(max(event_time)) as last"))
    days = bounds.filter("first is not null").selectExpr(
        "explode(sequence(first, last, interval 1 day)) as date_day"
    )
    return days.select("date_day", *calendar_columns("date_day"))


def dim_product(product_dim: DataFrame) -> DataFrame:
    """Products with blank or missing text replaced by ``unknown`` and flagged."""
    named = product_dim.filter("product_id is not null").selectExpr(
        "product_id",
        "category_id",
        f"{known_or_unknown('category_code')} as category_code",
        f"{known_or_unknown('brand')} as brand",
        "source_system",
        "loaded_at",
    )
    return named.selectExpr(
        "product_id",
        "category_id",
        "category_code",
        "brand",
        f"if(category_code = '{UNKNOWN}', 1, 0) as is_unknown_category",
        f"if(brand = '{UNKNOWN}', 1, 0) as is_unknown_brand",
        "source_system",
        "loaded_at",
    )


def or_zero(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(0)).alias(name)


def sessions_by_user(sessions: DataFrame) -> DataFrame:
    """Session totals per owning user; durations stay exact until they are divided."""
    return sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("owned_sessions"),
        F.expr(f"{sum_micros(micros('session_start', 'session_end'))} as owned_micros"),
        F.sum("events_in_session").alias("owned_events"),
        *(F.sum(f"has_{kind}").alias(f"{kind}_sessions") for kind in EVENT_TYPES),
    )


def owned_session_means() -> list[Column]:
    """Zero-filled means over the columns of ``sessions_by_user``."""
    return [
        or_zero(mean_minutes("owned_micros", "owned_sessions"), "avg_session_duration_minutes"),
        or_zero(ratio("owned_events", "owned_sessions"), "avg_events_per_session"),
    ]


def user_segment() -> Column:
    """First match wins: bought, carted, viewed, other."""
    return (
        F.when(F.col("conversion_count") > 0, "purchaser")
        .when(F.col("has_ever_carted") == 1, "carted_not_purchased")
        .when(F.col("has_ever_viewed") == 1, "viewer_only")
        .otherwise("other")
    )


def dim_user(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per user: activity, owned sessions, revenue, segment.

    ``total_sessions`` counts sessions in the user's own events, ``session_count``
    the sessions the user owns; they differ when users share a session id.

    A conversion is a purchase event of the same user, so conversion counts and
    revenue come out of the aggregate that already groups the events by user instead
    of a second scan, shuffle and join. The remaining join meets sessions aggregated
    by the same key, so it adds no exchange of its own and each side has one row per
    user, whatever the skew of the inputs.
    """
    paid = "if(event_type = 'purchase', price, null)"
    activity = events.groupBy("user_id").agg(
        F.min("event_time").alias("first_seen_at"),
        F.max("event_time").alias("last_seen_at"),
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("user_session").alias("total_sessions"),
        F.countDistinct("product_id").alias("total_products_interacted"),
        *event_counts(prefix="total_"),
        F.expr(f"cast(sum({paid}) as {TOTAL}) as revenue"),
        F.expr(f"count({paid}) as priced_purchases"),
    )
    profile = activity.join(sessions_by_user(sessions), "user_id", "left").select(
        "user_id",
        "first_seen_at",
        "last_seen_at",
        F.to_date("first_seen_at").alias("first_seen_date"),
        F.to_date("last_seen_at").alias("last_seen_date"),
        "total_events",
        "total_sessions",
        "total_products_interacted",
        "total_view_events",
        "total_cart_events",
        "total_purchase_events",
        or_zero("owned_sessions", "session_count"),
        *owned_session_means(),
        F.expr("if(view_sessions > 0, 1, 0) as has_ever_viewed"),
        F.expr("if(cart_sessions > 0, 1, 0) as has_ever_carted"),
        F.expr("if(purchase_sessions > 0, 1, 0) as has_ever_purchased"),
        F.col("total_purchase_events").alias("conversion_count"),
        F.expr(f"coalesce(revenue, cast(0 as {TOTAL})) as total_revenue"),
        or_zero(ratio("revenue", "priced_purchases"), "avg_purchase_value"),
    )
    return profile.select("*", user_segment().alias("user_segment"))
