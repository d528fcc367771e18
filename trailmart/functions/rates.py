"""Percentages, ratios, means and lifts in decimal arithmetic.

Arguments are SQL expressions: a column name or an aggregate such as ``sum(revenue)``.
Everything is rounded half away from zero to two places and is NULL when the
denominator is zero or NULL. The quotient keeps 14 or more fraction digits before
it is rounded, so the result does not depend on binary floating point or on the
order in which partitions are added up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmart.schemas import RATE

MICROS_PER_MINUTE = 60_000_000


def _rounded(numerator: str, denominator: str) -> Column:
    return F.expr(f"cast(round({numerator} / nullif({denominator}, 0), 2) as {RATE})")


def ratio(numerator: str, denominator: str) -> Column:
    """An amount or a count over a count."""
    return _rounded(f"cast({numerator} as decimal(24,2))", f"cast({denominator} as decimal(20,0))")


def pct(part: str, whole: str) -> Column:
    """``part`` as a percentage of ``whole``, both counts."""
    return ratio(f"100 * cast({part} as decimal(20,0))", whole)


def lift(value: str, control: str) -> Column:
    """Relative change in percent of one already rounded metric against control."""
    return _rounded(f"100 * cast({value} - {control} as decimal(22,2))", f"cast({control} as {RATE})")


def micros(start: str, end: str) -> str:
    """SQL for the exact time between two timestamps in microseconds."""
    return f"(unix_micros({end}) - unix_micros({start}))"


def sum_micros(value: str) -> str:
    """SQL for an exact total; a long would overflow at a few hundred billion sessions."""
    return f"sum(cast({value} as decimal(20,0)))"


def minutes(start: str, end: str) -> Column:
    """Time between two timestamps in fractional minutes."""
    return F.expr(f"{micros(start, end)} / {MICROS_PER_MINUTE}D")


def mean_minutes(total_micros: str, count: str) -> Column:
    """Mean duration in minutes from a total in microseconds."""
    return _rounded(f"cast({total_micros} as decimal(28,0))", f"(cast({count} as decimal(18,0)) * {MICROS_PER_MINUTE})")
