"""Cleaned events: the view every fact is built from."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.schemas import EVENT_TYPES, MONEY, REQUIRED


def stg_events(raw_events: DataFrame) -> DataFrame:
    """Usable events with calendar parts; rows without price or session are kept.

    A narrow projection over one filter, so a consumer that needs three columns
    scans three columns and the null checks reach the parquet reader. Weekdays count
    from Sunday = 0.
    """
    present = " and ".join(f"{name} is not null" for name in REQUIRED)
    usable = raw_events.filter(f"{present} and lower(trim(event_type)) in {EVENT_TYPES}")
    return usable.selectExpr(
        "event_id",
        "event_time",
        "to_date(event_time) as event_date",
        "hour(event_time) as event_hour",
        "dayofweek(event_time) - 1 as event_day_of_week",
        "trunc(event_time, 'month') as event_month",
        "lower(trim(event_type)) as event_type",
        "product_id",
        "category_id",
        f"cast(price as {MONEY}) as price",
        "user_id",
        "nullif(trim(user_session), '') as user_session",
        "source_file",
        "loaded_at",
    )


def of_days(raw_events: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Staged events of the days ``first`` to ``last``.

    The bounds are on the stored time itself, so files and row groups of other days are skipped.
    """
    start = datetime.datetime.combine(first, datetime.time(), datetime.timezone.utc)
    end = datetime.datetime.combine(last + datetime.timedelta(days=1), datetime.time(), datetime.timezone.utc)
    within = (F.col("event_time") >= F.lit(start)) & (F.col("event_time") < F.lit(end))
    return stg_events(raw_events.filter(within))
