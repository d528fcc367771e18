"""Distinct users and sessions that add up over days: one bitmap per day, merged for longer periods.

Distinct counts of days do not add up to that of a month, so counting them anew for every
period reads the events again. Here every value gets a dense number once; a day keeps the
numbers it has seen as bitmaps, and the count of any set of days is that of their union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.sources.files import stored

#: Count in the daily funnel, and the column it counts.
COUNTED = {"active_users": "user_id", "sessions": "user_session"}


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """Stored rows (value, id): every value of a column except NULL, numbered from 1 without gaps.

    Numbers follow the tasks that hold the distinct values; a row per task says where
    the numbers of each begin, so values are shuffled once, to make them distinct.
    """
    seen = df.filter(f"{column} is not null").select(F.col(column).alias("value")).distinct()
    placed = stored(seen.withColumn("place", F.monotonically_increasing_id()), "dictionary-values")
    task = F.shiftright("place", 33).alias("task")
    sizes = placed.groupBy(task).agg(F.count(F.lit(1)).alias("n"))
    begins = sizes.selectExpr("task", "sum(n) over (order by task) - n as begin")
    within = placed.select("value", task, F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("within"))
    return stored(within.join(begins, "task").selectExpr("value", "begin + within + 1 as id"), "dictionary")


def daily_bitmaps(events: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Rows (event_date, counted, bucket, bits) of staged events: the numbers seen on each day.

    Each counted column is read by itself and reduced to one row per day and value before
    it meets its dictionary. A bucket holds 32,768 numbers in 4 KB.
    """
    parts = []
    for name, column in COUNTED.items():
        seen = events.select("event_date", F.col(column).alias("value")).filter("value is not null").distinct()
        numbered = seen.join(dictionaries[name], "value")
        grouped = numbered.groupBy("event_date", F.bitmap_bucket_number("id").alias("bucket"))
        bits = grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
        parts.append(bits.select("event_date", F.lit(name).alias("counted"), "bucket", "bits"))
    return reduce(DataFrame.unionByName, parts)


def distinct_per_period(bitmaps: DataFrame, period: Column, name: str) -> DataFrame:
    """Distinct users and sessions of each period from stored daily bitmaps, whatever days it has."""
    merged = bitmaps.groupBy(period.alias(name), "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = merged.withColumn("n", F.bitmap_count("bits")).groupBy(name)
    return counts.agg(
        *(F.coalesce(F.sum(F.when(F.col("counted") == kind, F.col("n"))), F.lit(0)).alias(kind) for kind in COUNTED)
    )


def stored_bitmaps(events: DataFrame) -> DataFrame:
    """Daily bitmaps of staged events, written once with dictionaries made from the same events."""
    dictionaries = {name: dictionary(events, column) for name, column in COUNTED.items()}
    return stored(daily_bitmaps(events, dictionaries), "bitmaps")
