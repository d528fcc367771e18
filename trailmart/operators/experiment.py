"""Experiment assignment, per-user metrics, variant summary and lift against control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.functions.rates import lift, pct, ratio
from trailmart.functions.text import hash_bucket
from trailmart.operators.dimensions import or_zero, owned_session_means, sessions_by_user
from trailmart.schemas import EXPERIMENT_NAME, TOTAL

# Rounded metrics that are compared with control, with the name of their lift.
LIFTS = {
    "user_conversion_rate": "user_conversion_lift_pct",
    "revenue_per_user": "revenue_per_user_lift_pct",
    "revenue_per_session": "revenue_per_session_lift_pct",
    "avg_purchase_value": "avg_purchase_value_lift_pct",
    "session_cart_rate": "session_cart_rate_lift_pct",
    "session_purchase_rate": "session_purchase_rate_lift_pct",
}


def assign_variants(
    users: DataFrame, experiment: str = EXPERIMENT_NAME, control_share: int = 50, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Bucket 0-99 per user; buckets below ``control_share`` form the control group."""
    bucketed = users.selectExpr("*", f"{hash_bucket('user_id')} as assignment_bucket")
    return bucketed.select(
        "user_id",
        F.lit(experiment).alias("experiment_name"),
        F.expr(f"if(assignment_bucket < {control_share}, 'control', 'treatment') as experiment_variant"),
        "assignment_bucket",
        F.col("first_seen_date").alias("assigned_date"),
        *extra,
    )


def user_metrics(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Assignment plus zero-filled session and purchase metrics, one row per user.

    ``users`` is the user dimension, which already holds conversions and revenue per
    user; they are carried along instead of being aggregated and joined again.
    """
    carried = ("conversion_count", "total_revenue", "avg_purchase_value")
    assigned = assign_variants(users, extra=carried)
    return assigned.join(sessions_by_user(sessions), "user_id", "left").select(
        "experiment_name",
        "experiment_variant",
        "assignment_bucket",
        "assigned_date",
        "user_id",
        or_zero("owned_sessions", "total_sessions"),
        *owned_session_means(),
        or_zero("cart_sessions", "sessions_with_cart"),
        or_zero("purchase_sessions", "sessions_with_purchase"),
        F.col("conversion_count").alias("purchase_events"),
        "total_revenue",
        "avg_purchase_value",
        F.expr("if(conversion_count > 0, 1, 0) as is_purchaser"),
    )


def variant_summary(per_user: DataFrame) -> DataFrame:
    """Totals, rates and means per experiment and variant.

    ``per_user`` has one row per user, so rows are users and no distinct is needed.
    Means are means of the per-user rounded means.
    """
    totals = per_user.groupBy("experiment_name", "experiment_variant").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("total_sessions").alias("sessions"),
        F.sum("sessions_with_cart").alias("sessions_with_cart"),
        F.sum("sessions_with_purchase").alias("sessions_with_purchase"),
        F.sum("is_purchaser").alias("purchasers"),
        F.sum("purchase_events").alias("purchase_events"),
        F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("avg_session_duration_minutes").alias("duration_sum"),
        F.sum("avg_events_per_session").alias("events_sum"),
    )
    return totals.select(
        "experiment_name",
        "experiment_variant",
        "users",
        "sessions",
        "sessions_with_cart",
        "sessions_with_purchase",
        "purchasers",
        "purchase_events",
        "total_revenue",
        pct("purchasers", "users").alias("user_conversion_rate"),
        pct("sessions_with_cart", "sessions").alias("session_cart_rate"),
        pct("sessions_with_purchase", "sessions").alias("session_purchase_rate"),
        ratio("total_revenue", "users").alias("revenue_per_user"),
        ratio("total_revenue", "sessions").alias("revenue_per_session"),
        ratio("total_revenue", "purchase_events").alias("avg_purchase_value"),
        ratio("duration_sum", "users").alias("avg_session_duration_minutes"),
        ratio("events_sum", "users").alias("avg_events_per_session"),
    )


def result_status() -> Column:
    """Verdict from conversion and revenue per user; without a control it is mixed."""
    conversion, control_conversion = F.col("user_conversion_rate"), F.col("control.user_conversion_rate")
    revenue, control_revenue = F.col("revenue_per_user"), F.col("control.revenue_per_user")
    return (
        F.when(F.col("experiment_variant") == "control", "baseline")
        .when((conversion > control_conversion) & (revenue > control_revenue), "positive_lift")
        .when((conversion < control_conversion) & (revenue < control_revenue), "negative_lift")
        .otherwise("mixed_result")
    )


def lift_against_control(summary: DataFrame) -> DataFrame:
    """Every variant next to its experiment's control row, with lift and verdict.

    The control row is handed to its siblings by a window over the few variants of
    one experiment. A join of the summary with itself would evaluate the summary,
    and every scan below it, twice.
    """
    is_control = F.col("experiment_variant") == "control"
    control = F.first(F.when(is_control, F.struct(*LIFTS)), ignorenulls=True)
    siblings = Window.partitionBy("experiment_name")
    return summary.withColumn("control", control.over(siblings)).select(
        *summary.columns,
        *(lift(name, f"control.{name}").alias(alias) for name, alias in LIFTS.items()),
        result_status().alias("experiment_result_status"),
    )


def mart_experiment_results(users: DataFrame, sessions: DataFrame) -> DataFrame:
    return lift_against_control(variant_summary(user_metrics(users, sessions)))
