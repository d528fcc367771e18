"""Session, conversion and daily funnel facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.functions.rates import minutes, pct
from trailmart.schemas import EVENT_TYPES, MONEY, TOTAL

# Fixed labels, keyed by 4 * has_view + 2 * has_cart + has_purchase.
JOURNEY_BY_CODE = {
    7: "view_cart_purchase",
    6: "view_cart_no_purchase",
    5: "view_purchase_no_cart",
    4: "view_only",
    3: "cart_purchase_no_view",
    1: "purchase_only",
}


def event_counts(suffix: str = "_events", prefix: str = "") -> list[Column]:
    """One conditional count per event type, e.g. ``view_events``."""
    return [F.expr(f"count_if(event_type = '{kind}') as {prefix}{kind}{suffix}") for kind in EVENT_TYPES]


def type_flags() -> list[Column]:
    """0/1 per event type from the counts, e.g. ``has_view``."""
    return [F.expr(f"if({kind}_events > 0, 1, 0) as has_{kind}") for kind in EVENT_TYPES]


def journey_pattern() -> Column:
    """Label of the (view, cart, purchase) combination a session shows, in any order."""
    cases = " ".join(f"when {code} then '{label}'" for code, label in JOURNEY_BY_CODE.items())
    return F.expr(f"case 4 * has_view + 2 * has_cart + has_purchase {cases} else 'other' end as journey_pattern")


def fact_sessions(events: DataFrame) -> DataFrame:
    """One row per session id.

    A session seen under several users belongs to the smallest user id. The first
    exchange is on (session, product) after a map-side combine, so even a session
    holding a large share of all events is spread over many tasks. Flags follow from
    the counts and need no aggregate of their own.
    """
    per_session = (
        events.filter("user_session is not null")
        .groupBy("user_session")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.count(F.lit(1)).alias("events_in_session"),
            F.countDistinct("product_id").alias("unique_products_viewed"),
            *event_counts(),
            F.expr(f"cast(sum(if(event_type = 'purchase', price, cast(0 as {MONEY}))) as {TOTAL}) as session_revenue"),
        )
    )
    length = minutes("session_start", "session_end").alias("session_duration_minutes")
    return per_session.select("*", length, *type_flags()).select(
        "user_session",
        "user_id",
        "session_start",
        "session_end",
        "session_duration_minutes",
        "events_in_session",
        "unique_products_viewed",
        "has_view",
        "has_cart",
        "has_purchase",
        "view_events",
        "cart_events",
        "purchase_events",
        "session_revenue",
        journey_pattern(),
    )


def fact_conversions(events: DataFrame) -> DataFrame:
    """One row per purchase event; a missing price is kept and flagged."""
    return events.filter("event_type = 'purchase'").selectExpr(
        "event_id as conversion_id",
        "event_time",
        "event_date",
        "event_hour",
        "event_day_of_week",
        "event_month",
        "user_id",
        "user_session",
        "product_id",
        "category_id",
        "price as revenue",
        "if(price is null, 1, 0) as is_missing_revenue",
        "source_file",
        "loaded_at",
    )


def step_rates(view: str, cart: str, purchase: str, prefix: str = "") -> list[Column]:
    """The three step rates of one funnel, named ``<prefix>view_to_cart_rate`` and so on."""
    counts = {"view": view, "cart": cart, "purchase": purchase}
    steps = (("view", "cart"), ("cart", "purchase"), ("view", "purchase"))
    return [pct(counts[to], counts[of]).alias(f"{prefix}{of}_to_{to}_rate") for of, to in steps]


def fact_funnel_steps(events: DataFrame) -> DataFrame:
    """One row per day with event, user and session counts and step rates.

    Steps are independent, so a rate may exceed 100. The conditional distinct counts
    share one pass: Spark reduces the events to one row per day and user and one per
    day and session, each spread by its own key, before anything is grouped by day.
    """
    distinct = "count(distinct user_session)"
    daily = events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("user_session").alias("sessions"),
        *event_counts(),
        *(F.expr(f"{distinct} filter (where event_type = '{k}') as sessions_with_{k}") for k in EVENT_TYPES),
    )
    return daily.select(
        "*",
        *step_rates("view_events", "cart_events", "purchase_events", "event_"),
        *step_rates("sessions_with_view", "sessions_with_cart", "sessions_with_purchase", "session_"),
    )
