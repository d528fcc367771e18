"""Calendar parts with Sunday = 0 weekdays, Monday weeks and padded English names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9


def calendar_columns(day: str) -> list[Column]:
    """Everything the calendar says about the date column ``day``.

    Spark counts weekdays from Sunday = 1, hence the shift; ``trunc`` starts weeks on
    Monday.
    """
    parts = {
        "day_of_month": f"dayofmonth({day})",
        "month_number": f"month({day})",
        "year_number": f"year({day})",
        "quarter_number": f"quarter({day})",
        "day_of_week_number": f"dayofweek({day}) - 1",
        "day_of_week_name": f"rpad(date_format({day}, 'EEEE'), {NAME_WIDTH}, ' ')",
        "month_name": f"rpad(date_format({day}, 'MMMM'), {NAME_WIDTH}, ' ')",
        "week_start_date": f"trunc({day}, 'week')",
        "month_start_date": f"trunc({day}, 'month')",
        "quarter_start_date": f"trunc({day}, 'quarter')",
        "year_start_date": f"trunc({day}, 'year')",
        "is_weekend": f"if(dayofweek({day}) in (1, 7), 1, 0)",
    }
    return [F.expr(f"{text} as {name}") for name, text in parts.items()]
