"""Declared column tests, input validation and the gate over their results.

Results are rows ``(table_name, rule, column_name, failures)``. All row-level rules
of a table are counted in one aggregate over one scan; only ``unique`` needs a
shuffle of its own, which reads nothing but the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.text import empty_to_null
from trailmart.schemas import (
    EVENT_TYPES,
    JOURNEY_PATTERNS,
    LANDING_COLUMNS,
    RESULT_STATUSES,
    USER_SEGMENTS,
    VARIANTS,
)
from trailmart.sources.files import stored

FLAG = (0, 1)

# The declared tests of every table.
COLUMN_TESTS = {
    "raw_events": {
        "not_null": ("event_id", "event_time", "event_type", "product_id", "user_id"),
        "unique": ("event_id",),
        "accepted_values": {"event_type": EVENT_TYPES},
    },
    "product_dim": {
        "not_null": ("product_id", "category_code", "brand"),
        "unique": ("product_id",),
    },
    "stg_events": {
        "not_null": ("event_id", "event_time", "event_date", "event_type", "product_id", "user_id"),
        "unique": ("event_id",),
        "accepted_values": {"event_type": EVENT_TYPES},
    },
    "fact_sessions": {
        "not_null": (
            "user_session",
            "user_id",
            "session_start",
            "session_end",
            "events_in_session",
            "has_view",
            "has_cart",
            "has_purchase",
            "journey_pattern",
        ),
        "unique": ("user_session",),
        "accepted_values": {
            "has_view": FLAG,
            "has_cart": FLAG,
            "has_purchase": FLAG,
            "journey_pattern": JOURNEY_PATTERNS,
        },
    },
    "fact_funnel_steps": {
        "not_null": (
            "event_date",
            "total_events",
            "active_users",
            "sessions",
            "view_events",
            "cart_events",
            "purchase_events",
        ),
        "unique": ("event_date",),
    },
    "fact_conversions": {
        "not_null": (
            "conversion_id",
            "event_time",
            "event_date",
            "user_id",
            "product_id",
            "revenue",
            "is_missing_revenue",
        ),
        "unique": ("conversion_id",),
        "accepted_values": {"is_missing_revenue": FLAG},
    },
    "dim_date": {
        "not_null": ("date_day", "is_weekend"),
        "unique": ("date_day",),
        "accepted_values": {"is_weekend": FLAG},
    },
    "dim_product": {
        "not_null": ("product_id", "category_code", "brand", "is_unknown_category", "is_unknown_brand"),
        "unique": ("product_id",),
        "accepted_values": {"is_unknown_category": FLAG, "is_unknown_brand": FLAG},
    },
    "dim_user": {
        "not_null": (
            "user_id",
            "first_seen_at",
            "last_seen_at",
            "first_seen_date",
            "last_seen_date",
            "total_events",
            "total_sessions",
            "user_segment",
        ),
        "unique": ("user_id",),
        "accepted_values": {
            "has_ever_viewed": FLAG,
            "has_ever_carted": FLAG,
            "has_ever_purchased": FLAG,
            "user_segment": USER_SEGMENTS,
        },
    },
    "mart_growth_daily": {
        "not_null": ("event_date", "is_weekend", "total_events", "active_users", "sessions", "total_revenue"),
        "unique": ("event_date",),
        "accepted_values": {"is_weekend": FLAG},
    },
    "mart_revenue_attribution": {
        "not_null": (
            "event_date",
            "category_code",
            "brand",
            "is_unknown_category",
            "is_unknown_brand",
            "purchase_events",
            "total_revenue",
        ),
        "accepted_values": {"is_unknown_category": FLAG, "is_unknown_brand": FLAG},
    },
    "mart_experiment_results": {
        "not_null": (
            "experiment_name",
            "experiment_variant",
            "users",
            "sessions",
            "total_revenue",
            "experiment_result_status",
        ),
        "accepted_values": {"experiment_variant": VARIANTS, "experiment_result_status": RESULT_STATUSES},
    },
}
# Conditions every raw event must not violate (NULL passes).
ROW_CHECKS = {
    "raw_events": {
        "event_type": "event_type in ('view', 'cart', 'purchase')",
        "price": "price >= 0",
    },
}
#: Keys that are given out in order, so neighbouring rows have neighbouring numbers.
NUMBERED_KEYS = ("event_id", "conversion_id")
# Columns an input file must have filled, price included.
VALIDATED_COLUMNS = ("event_time", "event_type", "product_id", "price", "user_id")


def row_rules(table: str) -> list[tuple[str, str, str]]:
    """``(rule, column, violated)`` for everything one scan of ``table`` can decide."""
    declared = COLUMN_TESTS.get(table, {})
    rules = [("not_null", name, f"{name} is null") for name in declared.get("not_null", ())]
    for name, values in declared.get("accepted_values", {}).items():
        rules.append(("accepted_values", name, f"{name} not in {values}"))
    for name, condition in ROW_CHECKS.get(table, {}).items():
        rules.append(("check", name, f"not ({condition})"))
    return rules


def count_violations(df: DataFrame, table: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One aggregated row with a counter per rule, turned into one row per rule."""
    counters = [F.expr(f"count_if({violated}) as r{i}") for i, (_, _, violated) in enumerate(rules)]
    results = ", ".join(
        f"struct('{table}' as table_name, '{rule}' as rule, '{name}' as column_name, r{i} as failures)"
        for i, (rule, name, _) in enumerate(rules)
    )
    return df.agg(*counters).selectExpr(f"inline(array({results}))")


def duplicated_values(df: DataFrame, table: str, name: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    repeated = df.filter(f"{name} is not null").groupBy(name).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), F.lit(name).alias("column_name"), "failures"
    )


def duplicated_numbers(df: DataFrame, table: str, name: str) -> DataFrame:
    """The same for numbers given out in order, without moving each of them.

    Tasks send one bitmap of 4 KB for each 32,768 neighbouring numbers they hold; where a
    union has fewer bits than there were rows, a number occurs twice. Only the numbers of such
    stretches are looked at one by one. The bitmaps are counted when this is called.
    """
    numbers = df.filter(f"{name} is not null").select(name, F.bitmap_bucket_number(name).alias("bucket"))
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(name)))
    counts = numbers.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), bits.alias("distinct_n"))
    crowded = stored(counts.filter("n > distinct_n").select("bucket"), "crowded")
    if crowded.isEmpty():
        report = f"select '{table}' as table_name, 'unique' as rule, '{name}' as column_name, 0L as failures"
        return df.sparkSession.sql(report)
    return duplicated_values(numbers.join(crowded, "bucket", "left_semi"), table, name)


def check_table(df: DataFrame, table: str) -> DataFrame:
    """All declared tests and row checks of one table."""
    parts = [count_violations(df, table, row_rules(table))]
    for name in COLUMN_TESTS[table].get("unique", ()):
        in_order = name in NUMBERED_KEYS
        parts.append(duplicated_numbers(df, table, name) if in_order else duplicated_values(df, table, name))
    return reduce(DataFrame.unionByName, parts)


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The tests of several tables; give it written tables, they are scanned per check."""
    return reduce(DataFrame.unionByName, (check_table(df, name) for name, df in tables.items()))


def gate(results: DataFrame) -> None:
    """Raise with the failed rules. There is one row per rule, so this stays small."""
    failed = results.filter(F.col("failures") > 0).orderBy("table_name", "rule", "column_name").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.rule}: {r.failures}" for r in failed]
        raise ValueError("data quality failures\n" + "\n".join(lines))


def extra_columns(header: list[str]) -> list[str]:
    """Columns nothing expects; they are reported, not an error."""
    return [name for name in header if name not in LANDING_COLUMNS]


def validate_header(spark: SparkSession, header: list[str], source: str = "landing") -> DataFrame:
    """A ``required_column`` row per expected column and an ``extra_column`` row per other one.

    Decided from the header of the files, no data is read. A missing column is a failure,
    an extra one is reported without being one.
    """
    rows = [(source, "required_column", name, int(name not in header)) for name in LANDING_COLUMNS]
    rows += [(source, "extra_column", name, 0) for name in extra_columns(header)]
    return spark.createDataFrame(rows, "table_name string, rule string, column_name string, failures bigint")


def validate_landing(landing: DataFrame, source: str = "landing") -> DataFrame:
    """Broken lines, event types as written, before clean-up, and empty required fields.

    Every row is checked, in one scan.
    """
    rules = [("well_formed", "line", "malformed is not null")]
    rules += [("accepted_values", "event_type", f"{empty_to_null('event_type')} not in {EVENT_TYPES}")]
    rules += [("not_null", name, f"{empty_to_null(name)} is null") for name in VALIDATED_COLUMNS]
    return count_violations(landing, source, rules)


def validate_file(landing: DataFrame, header: list[str], source: str = "landing") -> None:
    """Header first, then contents; raises at the first stage that fails."""
    gate(validate_header(landing.sparkSession, header, source))
    for name in extra_columns(header):
        print(f"{source}: unexpected column {name} is ignored")
    gate(validate_landing(landing, source))


def invalid_event_types(landing: DataFrame) -> DataFrame:
    """The distinct event types outside the accepted ones, with their number of rows."""
    return (
        landing.filter(f"{empty_to_null('event_type')} not in {EVENT_TYPES}")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
