"""Approximate distinct counts that merge: HLL sketches per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.operators.profiling import CARDINALITIES

#: Logarithm of the number of registers: 32 KB a sketch, standard error 0.6 per cent.
PRECISION = 15


def daily_sketches(events: DataFrame) -> DataFrame:
    """One row per day with a sketch of the values of each counted column; one pass over the events.

    Events without a time make a day of their own, NULL. Tasks send one sketch per day
    and column, whatever the number of events.
    """
    sketches = (
        F.hll_sketch_agg(F.col(column).cast("string"), PRECISION).alias(name) for name, column in CARDINALITIES.items()
    )
    return events.groupBy(F.to_date("event_time").alias("event_date")).agg(*sketches)


def estimates(sketches: DataFrame, *period: Column) -> DataFrame:
    """Rows (period ..., metric, value): estimated distinct values of all days of each period."""
    merged = sketches.groupBy(*period).agg(
        *(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in CARDINALITIES)
    )
    kept = [name for name in merged.columns if name not in CARDINALITIES]
    cells = ", ".join(f"struct('{name}' as metric, {name} as value)" for name in CARDINALITIES)
    return merged.selectExpr(*kept, f"inline(array({cells}))")
