"""Summaries printed after a load: counts, ranges, NULL counts, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.schemas import UNKNOWN

# Columns whose NULLs are counted after a load.
NULL_CHECKED = ("event_time", "event_type", "product_id", "user_id", "user_session", "price")


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def event_type_counts(events: DataFrame) -> DataFrame:
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    return counts.orderBy(F.desc("event_count"), "event_type")


def event_time_range(events: DataFrame) -> DataFrame:
    return events.agg(F.min("event_time").alias("min_event_time"), F.max("event_time").alias("max_event_time"))


def null_counts(events: DataFrame) -> DataFrame:
    return events.agg(*(F.expr(f"count_if({name} is null) as null_{name}") for name in NULL_CHECKED))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows; stops reading as soon as it has them."""
    return df.limit(n)


def unknown_products(products: DataFrame) -> DataFrame:
    """Product count and how many lack a category or a brand, in one pass."""
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.expr(f"count_if(category_code = '{UNKNOWN}') as unknown_categories"),
        F.expr(f"count_if(brand = '{UNKNOWN}') as unknown_brands"),
    )


def sample_check(sample: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of a stored sample, and how many of them the source does not have that often."""
    foreign = sample.exceptAll(source).agg(F.count(F.lit(1)).alias("not_in_source"))
    rows = row_count(sample, "sample_rows")
    return rows.select("sample_rows", foreign.scalar().alias("not_in_source"))
