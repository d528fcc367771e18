"""Rounding and golden values of the rate helpers."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from trailmart.functions.rates import lift, mean_minutes, pct, ratio


def one(spark, column, **values):
    cells = ", ".join(f"cast({value} as {kind}) as {name}" for name, (value, kind) in values.items())
    return spark.sql(f"select {cells}").select(column.alias("x")).first().x


def count_pair(a, b):
    return {"a": (a, "bigint"), "b": (b, "bigint")}


# Published daily counts and the rates that belong to them.
@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [
        (16609, 1202082, "1.38"),
        (19243, 16609, "115.86"),
        (19243, 1202082, "1.60"),
        (10140, 267390, "3.79"),
        (16198, 10140, "159.74"),
        (16198, 267390, "6.06"),
        (19243, 267498, "7.19"),
        (17256, 1155073, "1.49"),
        (19470, 17256, "112.83"),
    ],
)
def test_golden_percentages(spark, part, whole, expected):
    assert one(spark, pct("a", "b"), **count_pair(part, whole)) == Decimal(expected)


@pytest.mark.parametrize(
    ("revenue", "count", "expected"),
    [("6254327.63", 189389, "33.02"), ("6254327.63", 267498, "23.38"), ("6214021.37", 185085, "33.57")],
)
def test_golden_ratios(spark, revenue, count, expected):
    value = one(spark, ratio("a", "b"), a=(revenue, "decimal(20,2)"), b=(count, "bigint"))
    assert value == Decimal(expected)


# Rounded treatment and control metrics with the published lift.
@pytest.mark.parametrize(
    ("value", "control", "expected"),
    [
        ("11.45", "11.52", "-0.61"),
        ("75.22", "76.96", "-2.26"),
        ("24.64", "25.11", "-1.87"),
        ("308.15", "310.95", "-0.90"),
        ("6.18", "6.22", "-0.64"),
        ("6.79", "6.83", "-0.59"),
    ],
)
def test_golden_lifts(spark, value, control, expected):
    kind = "decimal(18,2)"
    assert one(spark, lift("a", "b"), a=(value, kind), b=(control, kind)) == Decimal(expected)


def test_ties_round_away_from_zero(spark):
    kind = "decimal(18,2)"
    assert one(spark, pct("a", "b"), **count_pair(1, 800)) == Decimal("0.13")
    # A change of 0.01 on 8.00 is exactly 0.125 percent.
    assert one(spark, lift("a", "b"), a=("7.99", kind), b=("8.00", kind)) == Decimal("-0.13")
    assert one(spark, lift("a", "b"), a=("8.01", kind), b=("8.00", kind)) == Decimal("0.13")


@pytest.mark.parametrize("whole", ["0", "null"])
def test_no_denominator_gives_null(spark, whole):
    assert one(spark, pct("a", "b"), **count_pair(3, whole)) is None
    assert one(spark, mean_minutes("a", "b"), **count_pair(3, whole)) is None
    assert one(spark, lift("a", "b"), a=(1, "decimal(18,2)"), b=(whole, "decimal(18,2)")) is None


def test_mean_is_rounded_once(spark):
    # Rounding to six places first would give 0.01.
    value = one(spark, ratio("a", "b"), a=("14999.99", "decimal(20,2)"), b=(3000000, "bigint"))
    assert value == Decimal("0.00")


def test_large_totals_do_not_overflow(spark):
    micros = 10**24
    assert one(spark, mean_minutes("a", "b"), a=(micros, "decimal(30,0)"), b=(10**12, "bigint")) == Decimal("16666.67")


def test_percentages_match_decimal_arithmetic(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(10**6), rng.randrange(1, 10**6)) for _ in range(500)]
    rows = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", pct("a", "b").alias("x")).collect()
    for row in rows:
        exact = (Decimal(100 * row.a) / Decimal(row.b)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row.x == exact
