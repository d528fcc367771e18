"""Product master: extraction from event rows, and the sync into the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.text import category_or_null, empty_to_null, whole_or_null
from trailmart.schemas import SOURCE_SYSTEM, UNKNOWN


def product_master(landing: DataFrame) -> DataFrame:
    """One row per product id: the attributes of its first event row.

    First is by path of the file, then by order within it: neither sizes of files nor
    the way they are split changes the outcome. Rows are collapsed to one per distinct
    set of attributes and file first. That step needs only a numeric minimum, so it runs
    as a hash aggregate with map-side combine and a product with a third of all events
    still leaves each task as a few rows. The choice of the first set then works on the
    small remainder.
    """
    attributes = ("category_id", "category_code", "brand")
    texts = (f"coalesce({empty_to_null(name)}, '{UNKNOWN}') as {name}" for name in ("category_code", "brand"))
    rows = landing.selectExpr(
        f"{whole_or_null('product_id')} as product_id",
        f"{category_or_null('category_id')} as category_id",
        *texts,
        "file_path",
        "load_order",
    )
    known = rows.filter("product_id is not null")
    variants = known.groupBy("product_id", *attributes, "file_path").agg(F.min("load_order").alias("load_order"))
    first = F.min_by(F.struct(*attributes), F.struct("file_path", "load_order")).alias("first")
    return variants.groupBy("product_id").agg(first).select("product_id", "first.*")


def sync_products(master: DataFrame) -> DataFrame:
    """The master as the warehouse stores it: no missing text, origin and load time added."""
    return master.select(
        "product_id",
        "category_id",
        *(F.coalesce(name, F.lit(UNKNOWN)).alias(name) for name in ("category_code", "brand")),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.current_timestamp().alias("loaded_at"),
    )
