"""Schemas, types and the fixed values every layer agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# They appear in inputs or outputs and must be exactly these.
EVENT_TYPES = ("view", "cart", "purchase")
JOURNEY_PATTERNS = (
    "view_cart_purchase",
    "view_cart_no_purchase",
    "view_purchase_no_cart",
    "view_only",
    "cart_purchase_no_view",
    "purchase_only",
    "other",
)
USER_SEGMENTS = ("purchaser", "carted_not_purchased", "viewer_only", "other")
VARIANTS = ("control", "treatment")
RESULT_STATUSES = ("baseline", "positive_lift", "negative_lift", "mixed_result")
EXPERIMENT_NAME = "search_ranking_experiment_v1"
SOURCE_SYSTEM = "mysql_product_master"
UNKNOWN = "unknown"
REQUIRED = ("event_time", "event_type", "product_id", "user_id")
LANDING_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)

# Single amounts are decimal(12,2). Totals are wider than single amounts because a
# sum over billions of rows must not overflow; rates and means share RATE.
MONEY = "decimal(12,2)"
TOTAL = "decimal(20,2)"
RATE = "decimal(18,2)"
CATEGORY = "decimal(20,0)"

RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("product_id", T.LongType(), False),
        T.StructField("category_id", T.DecimalType(20, 0)),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("user_session", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

PRODUCT_DIM = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.DecimalType(20, 0)),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
