"""Exploration reports over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.rates import (
    MICROS_PER_MINUTE,
    mean_minutes,
    micros,
    minutes,
    pct,
    ratio,
    sum_micros,
)
from trailmart.functions.text import hash_bucket, time_or_null
from trailmart.operators.facts import event_counts, journey_pattern, step_rates, type_flags
from trailmart.operators.quantiles import point_quantiles, value_points
from trailmart.schemas import EVENT_TYPES, TOTAL, UNKNOWN

PRICE_QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def as_rows(one_row: DataFrame, columns: list[str], key: str, value: str) -> DataFrame:
    """Turn the columns of a one-row report into rows ``(key, value)``."""
    cells = ", ".join(f"struct('{name}' as {key}, {name} as {value})" for name in columns)
    return one_row.selectExpr(f"inline(array({cells}))")


def missing_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Missing count and share per column, most missing first; one pass."""
    missing = df.agg(
        F.count(F.lit(1)).alias("total"), *(F.expr(f"count_if({name} is null) as {name}") for name in columns)
    )
    cells = ", ".join(f"struct('{name}' as field, {name} as missing_count)" for name in columns)
    report = missing.selectExpr("total", f"inline(array({cells}))")
    shares = report.select("field", "missing_count", pct("missing_count", "total").alias("missing_pct"))
    return shares.orderBy(F.desc("missing_count"), "field")


def distinct_values(df: DataFrame, columns: dict[str, str], key: str, value: str) -> DataFrame:
    """Rows ``(key, value)``: distinct values of each column, counted in a scan of that column.

    Several distinct counts in one aggregate would expand every row once per column.
    """
    counts = (
        df.select(column).agg(F.count_distinct(column).alias(value)).select(F.lit(name).alias(key), value)
        for name, column in columns.items()
    )
    return reduce(DataFrame.unionByName, counts)


def metadata_quality(df: DataFrame, columns: tuple[str, ...] = ("category_code", "brand")) -> DataFrame:
    """Missing values plus the number of distinct values of descriptive columns."""
    found = distinct_values(df, {name: name for name in columns}, "field", "unique_non_null_values")
    return missing_values(df.select(*columns), columns).join(found, "field")


def value_counts(df: DataFrame, column: str, count: str, share: str) -> DataFrame:
    """Rows per non-NULL value with their share of all of them, most frequent first.

    The total is a scalar subquery over the counts, not a window over one partition.
    """
    counts = df.filter(f"{column} is not null").groupBy(column).agg(F.count(F.lit(1)).alias(count))
    total = counts.agg(F.sum(count)).scalar().alias("total")
    shares = counts.select("*", total).select(column, count, pct(count, "total").alias(share))
    return shares.orderBy(F.desc(count), column)


def time_profile(landing_text: DataFrame) -> DataFrame:
    """Timestamps that do not parse, and the range of those that do."""
    parsed = F.expr(time_or_null("event_time"))
    return landing_text.agg(
        F.count_if(parsed.isNull()).alias("invalid_timestamps"),
        F.min(parsed).alias("min_event_time"),
        F.max(parsed).alias("max_event_time"),
    )


def daily_activity(events: DataFrame) -> DataFrame:
    day = F.to_date("event_time").alias("event_date")
    return (
        events.filter(F.col("event_time").isNotNull())
        .groupBy(day)
        .agg(
            F.count("event_type").alias("total_events"),
            F.countDistinct("user_id").alias("active_users"),
            F.countDistinct("user_session").alias("sessions"),
        )
    )


# Names of the distinct counts and the columns they count.
CARDINALITIES = {
    "unique_users": "user_id",
    "unique_sessions": "user_session",
    "unique_products": "product_id",
    "unique_categories": "category_id",
    "unique_category_codes": "category_code",
    "unique_brands": "brand",
}


def cardinality(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values of six columns; ``approximate`` trades exactness for a single pass.

    Estimates that merge over days are in ``sketches``.
    """
    if not approximate:
        return distinct_values(events, CARDINALITIES, "metric", "value")
    row = events.agg(*(F.approx_count_distinct(column).alias(name) for name, column in CARDINALITIES.items()))
    return as_rows(row, list(CARDINALITIES), "metric", "value")


def top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent values, missing counted as ``unknown``; ties by name."""
    value = F.coalesce(F.col(column), F.lit(UNKNOWN)).alias(column)
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("event_count"))
    return counts.orderBy(F.desc("event_count"), column).limit(k)


def price_points(events: DataFrame) -> DataFrame:
    """One stored row per price in cents with its number of events: the events are read once."""
    return value_points(events, {"c": "price * 100"}, label="prices")


def price_summary(events: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, extremes and quantiles of the price."""
    points = price_points(events)
    quantiles = point_quantiles(points, {"c": PRICE_QUANTILES}).selectExpr(
        "concat(cast(probability * 100 as int), '%') as statistic", "cast(round(value / 100, 4) as double) as value"
    )
    sums = points.withColumnRenamed("v", "c").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("k"),
        F.expr("sum(cast(c * n as decimal(38,0))) as s"),
        F.expr("sum(cast(c as decimal(19,0)) * c * n) as q"),
        F.min("c").alias("low"),
        F.max("c").alias("high"),
    )
    stats = {
        "count": "cast(k as double)",
        "mean": "cast(s as double) / 100 / nullif(k, 0)",
        "std": "sqrt(cast(k * q - s * s as double) / nullif(k, 0) / nullif(k - 1, 0)) / 100",
        "min": "cast(low as double) / 100",
        "max": "cast(high as double) / 100",
    }
    one = sums.selectExpr(*(f"round({text}, 4) as {name}" for name, text in stats.items()))
    return as_rows(one, list(stats), "statistic", "value").unionByName(quantiles)


# Metrics of the purchase summary, in order.
PURCHASE_METRICS = [
    "purchase_events",
    "purchasing_users",
    "purchasing_sessions",
    "sample_revenue",
    "avg_purchase_value",
    "min_purchase_price",
    "max_purchase_price",
]


def purchase_summary(events: DataFrame) -> DataFrame:
    numbers = (
        F.count(F.lit(1)),
        F.countDistinct("user_id"),
        F.countDistinct("user_session"),
        F.sum("price"),
        ratio("sum(price)", "count(price)"),
        F.min("price"),
        F.max("price"),
    )
    one = events.filter("event_type = 'purchase'").agg(
        *(value.cast(TOTAL).alias(name) for name, value in zip(PURCHASE_METRICS, numbers, strict=True))
    )
    return as_rows(one, PURCHASE_METRICS, "metric", "value")


def histogram(events: DataFrame, bins: int = 50, up_to: float | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest price; the last bin is closed.

    ``up_to`` keeps prices up to that quantile. The events are read once and reduced
    to one stored row per price; the cut, the bounds and the bins come from those. Bin
    numbers are whole-number arithmetic on cents, so no price sits on the wrong side
    of an edge. Empty bins are present with a count of zero.
    """
    points = price_points(events).selectExpr("name", "v", "n", "v as c")
    if up_to is not None:
        cut = point_quantiles(points, {"c": (up_to,)}).first()
        points = points.filter(F.col("c") <= F.lit(cut.value)) if cut else points
    # Where all prices are equal the bins span half a unit to either side.
    bounds = points.agg(F.min("c").alias("lo"), F.max("c").alias("hi")).selectExpr(
        "if(lo = hi, lo - 50, lo) as lo", "if(lo = hi, hi + 50, hi) as hi"
    )
    limits = bounds.select("lo").scalar().alias("lo"), bounds.select("hi").scalar().alias("hi")
    within = f"least((c - lo) * {bins} div (hi - lo) + 1, {bins})"
    counted = (
        points.select("c", "n", *limits)
        .selectExpr("n", f"cast({within} as int) as bin")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    edges = events.sparkSession.range(1, bins + 1).select(F.expr("cast(id as int) as bin"), *limits)
    width = f"(hi - lo) / {bins}D"
    return edges.join(counted, "bin", "left").selectExpr(
        "bin",
        f"round((lo + {width} * (bin - 1)) / 100, 4) as bin_start",
        f"round((lo + {width} * bin) / 100, 4) as bin_end",
        "coalesce(n, 0) as price_count",
    )


def event_funnel(events: DataFrame) -> DataFrame:
    """Events per step in funnel order with their share of views."""
    steps = ", ".join(
        f"struct({position} as step_number, '{kind}' as funnel_step, {kind} as event_count)"
        for position, kind in enumerate(EVENT_TYPES, start=1)
    )
    counts = events.agg(*event_counts(suffix="")).selectExpr("view", f"inline(array({steps}))")
    share = pct("event_count", "view").alias("pct_of_views")
    return counts.select("step_number", "funnel_step", "event_count", share)


def event_funnel_rates(events: DataFrame) -> DataFrame:
    one = events.agg(*event_counts(suffix="")).select(*step_rates(*EVENT_TYPES))
    return as_rows(one, one.columns, "metric", "value_pct")


def session_profile(events: DataFrame) -> DataFrame:
    """One row per session of the untyped funnel: any event type counts as an event."""
    per_session = (
        events.filter("user_session is not null")
        .groupBy("user_session")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.count("event_type").alias("events_in_session"),
            *event_counts(),
        )
    )
    flagged = per_session.select(
        "user_session",
        "user_id",
        "session_start",
        "session_end",
        "events_in_session",
        *type_flags(),
        minutes("session_start", "session_end").alias("session_duration_minutes"),
    )
    return flagged.select("*", journey_pattern())


# Metrics of the session summary, in order.
SESSION_METRICS = [
    "total_sessions",
    "sessions_with_view",
    "sessions_with_cart",
    "sessions_with_purchase",
    "avg_events_per_session",
]


def session_totals(sessions: DataFrame) -> DataFrame:
    """Session counts and means as one row, from session rows."""
    span = micros("session_start", "session_end")
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        *(F.sum(f"has_{kind}").alias(f"sessions_with_{kind}") for kind in EVENT_TYPES),
        ratio("sum(events_in_session)", "count(1)").alias("avg_events_per_session"),
        mean_minutes(sum_micros(span), f"count({span})").alias("avg_session_duration_minutes"),
    )


def session_summary(sessions: DataFrame) -> DataFrame:
    one = session_totals(sessions).select(*(F.col(name).cast(TOTAL).alias(name) for name in SESSION_METRICS))
    return as_rows(one, SESSION_METRICS, "metric", "value")


def session_summary_with_medians(sessions: DataFrame) -> DataFrame:
    """The session summary plus mean duration and exact medians of events and duration."""
    names = [*SESSION_METRICS, "avg_session_duration_minutes"]
    one = session_totals(sessions).select(*(F.col(name).cast(TOTAL).alias(name) for name in names))
    medians = {
        "median_events_per_session": ("events_in_session", 1),
        "median_session_duration_minutes": (micros("session_start", "session_end"), MICROS_PER_MINUTE),
    }
    points = value_points(sessions, {name: column for name, (column, _) in medians.items()}, label="sessions-points")
    middle = point_quantiles(points, {name: (0.5,) for name in medians})
    unit = "case name " + " ".join(f"when '{name}' then {unit}" for name, (_, unit) in medians.items()) + " end"
    rounded = F.expr(f"round(value / cast({unit} as decimal(10,0)), 2)").cast(TOTAL)
    return as_rows(one, names, "metric", "value").unionByName(
        middle.select(F.col("name").alias("metric"), rounded.alias("value"))
    )


def session_funnel_rates(sessions: DataFrame) -> DataFrame:
    steps = (f"sessions_with_{kind}" for kind in EVENT_TYPES)
    one = session_totals(sessions).select(*step_rates(*steps, prefix="session_"))
    return as_rows(one, one.columns, "metric", "value_pct")


def random_sample(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """Row sample without replacement; which rows depends on the partitioning of ``df``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def session_sample(events: DataFrame, one_in: int = 100) -> DataFrame:
    """All events of one in ``one_in`` sessions, chosen by a hash of the session id."""
    return events.filter(f"{hash_bucket('user_session', one_in)} = 0")
