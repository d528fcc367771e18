"""Daily growth and revenue attribution marts, and the report over attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.rates import pct, ratio
from trailmart.schemas import MONEY, TOTAL, UNKNOWN

ATTRIBUTION_KEYS = (
    "event_date",
    "event_month",
    "category_id",
    "category_code",
    "brand",
    "is_unknown_category",
    "is_unknown_brand",
)


def daily_revenue(conversions: DataFrame) -> DataFrame:
    return conversions.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("purchase_events"),
        F.countDistinct("user_id").alias("purchasing_users"),
        F.countDistinct("user_session").alias("purchasing_sessions"),
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        ratio("sum(revenue)", "count(revenue)").cast(MONEY).alias("avg_purchase_value"),
    )


def mart_growth_daily(funnel: DataFrame, conversions: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per day that has events, with calendar, funnel and revenue metrics.

    All three inputs are one row per day by the time they meet, so the joins are
    small whatever the size of the facts.
    """
    revenue = daily_revenue(conversions)
    calendar = dates.select(
        F.col("date_day").alias("event_date"),
        "day_of_month",
        "month_number",
        "month_name",
        "year_number",
        "quarter_number",
        "day_of_week_number",
        "day_of_week_name",
        "week_start_date",
        "month_start_date",
        "is_weekend",
    )
    steps = funnel.withColumnRenamed("purchase_events", "funnel_purchase_events")
    filled = steps.join(revenue, "event_date", "left").join(calendar, "event_date", "left").na.fill(
        0, [name for name in revenue.columns if name != "event_date"]
    )
    return filled.select(
        *calendar.columns,
        "total_events",
        "active_users",
        "sessions",
        "view_events",
        "cart_events",
        "funnel_purchase_events",
        "purchase_events",
        "purchasing_users",
        "purchasing_sessions",
        "total_revenue",
        "avg_purchase_value",
        "sessions_with_view",
        "sessions_with_cart",
        "sessions_with_purchase",
        *(name for name in funnel.columns if name.endswith("_rate")),
        ratio("total_revenue", "active_users").alias("revenue_per_active_user"),
        ratio("total_revenue", "sessions").alias("revenue_per_session"),
        pct("purchase_events", "sessions").alias("purchase_events_per_session_pct"),
    )


def mart_revenue_attribution(conversions: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue by day, category and brand.

    The category id is the event's, code and brand are the product's. A purchase
    without a product gets the text ``unknown`` but keeps NULL flags, so it stays
    apart from a known product of unknown brand.

    The product side is broadcast only when its measured size allows it; beyond that
    the sort-merge join lets AQE split a hot product.
    """
    described = products.select("product_id", "category_code", "brand", "is_unknown_category", "is_unknown_brand")
    sold = conversions.select(
        "event_date", "event_month", "product_id", "category_id", "user_id", "user_session", "revenue"
    )
    joined = sold.join(described, "product_id", "left").na.fill(UNKNOWN, ["category_code", "brand"])
    return joined.groupBy(*ATTRIBUTION_KEYS).agg(
        F.count(F.lit(1)).alias("purchase_events"),
        F.countDistinct("user_id").alias("purchasing_users"),
        F.countDistinct("user_session").alias("purchasing_sessions"),
        F.countDistinct("product_id").alias("purchased_products"),
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        ratio("sum(revenue)", "count(revenue)").cast(MONEY).alias("avg_purchase_value"),
        F.min("revenue").alias("min_purchase_value"),
        F.max("revenue").alias("max_purchase_value"),
    )


def top_category_brands(attribution: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` category and brand pairs with most revenue; missing revenue sorts first."""
    return (
        attribution.groupBy("category_code", "brand")
        .agg(
            F.sum("total_revenue").cast(TOTAL).alias("revenue"),
            F.sum("purchase_events").alias("purchases"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "category_code", "brand")
        .limit(k)
    )


def top_attribution_rows(attribution: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` attribution rows with most revenue; missing revenue sorts first."""
    ties = [F.asc_nulls_last(name) for name in ATTRIBUTION_KEYS]
    return attribution.orderBy(F.desc_nulls_first("total_revenue"), *ties).limit(k)
