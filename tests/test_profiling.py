"""Quantiles, histogram and samples against brute force."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmart.operators import profiling, quantiles

PROBABILITIES = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def quantiles_of(df, column, probabilities, weight="1"):
    return quantiles.exact_quantiles(df, column, probabilities, weight).collect()


def found_quantiles(spark, values):
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint").repartition(5)
    rows = quantiles_of(df, "v", PROBABILITIES)
    return {float(r.probability): float(r.value) for r in rows}


@pytest.mark.parametrize("case", ["uniform", "skewed", "repeated", "negative", "durations", "huge", "single", "pair"])
def test_exact_quantiles(spark, case):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.integers(0, 10_000, 1001),
        "skewed": np.floor(rng.lognormal(8, 3, 2000)),
        "repeated": np.r_[np.full(700, 5), rng.integers(0, 50, 301)],
        "negative": rng.integers(-5000, 5000, 999),
        "durations": rng.integers(0, 3 * 10**9, 3000),
        "huge": rng.integers(10**12, 10**12 + 50, 500),
        "single": np.array([42]),
        "pair": np.array([1, 4]),
    }[case]
    found = found_quantiles(spark, values)
    for p in PROBABILITIES:
        assert found[p] == pytest.approx(np.quantile(values, p), abs=1e-5), p


def test_quantiles_over_the_whole_range_of_longs(spark):
    edges = {0, 1, 65535, 65536, 2**40 - 1, 2**40, 2**62}
    numbers = sorted({*edges, *(-n for n in edges), *range(-70_000, 70_000, 97)})
    chosen = [k / (len(numbers) - 1) for k in (0, 1, 2, 6, len(numbers) - 2, len(numbers) - 1)]
    df = spark.createDataFrame([(n,) for n in numbers], "v bigint")
    for r in quantiles_of(df, "v", tuple(chosen)):
        place = float(r.probability) * (len(numbers) - 1)
        low, high = numbers[int(place + 1e-9)], numbers[min(int(place + 1e-9) + 1, len(numbers) - 1)]
        assert low <= r.value <= high


def test_quantiles_of_several_columns_in_one_pass(spark):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 10**11, 4000), rng.integers(-50, 50, 4000)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a bigint, b bigint")
    points = quantiles.value_points(df, {"first": "a", "second": "b", "none": "nullif(b, b)"})
    found = quantiles.point_quantiles(points, {"first": (0.5, 0.99), "second": (0.1,), "none": (0.5,)}).collect()
    expected = {("first", 0.5): (a, 0.5), ("first", 0.99): (a, 0.99), ("second", 0.1): (b, 0.1)}
    assert {(r["name"], float(r.probability)) for r in found} == set(expected)
    for r in found:
        values, p = expected[r["name"], float(r.probability)]
        assert float(r.value) == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-5)


def test_levels_grow_with_the_logarithm_of_the_range(spark, monkeypatch):
    """Each level is one plan that scans the points once; a range of 2^40 needs three."""
    plans = []
    refined = quantiles.refined

    def watched(points, ranges):
        df = refined(points, ranges)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(quantiles, "refined", watched)
    df = spark.range(20_000).selectExpr("id * id * 2748 as v")
    quantiles.exact_quantiles(df, "v", (0.1, 0.5, 0.9)).collect()
    assert 1 < len(plans) <= 3
    for text in plans:
        assert text.count("FileScan") == 1 and text.count("hashpartitioning(id") <= 2
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_quantiles_of_many_values_that_lie_together(spark):
    # Three hundred thousand distinct times of one afternoon, in microseconds.
    base = 1_569_888_000_000_000
    df = spark.range(300_000).selectExpr(f"{base} + (id * 7919) % 300000 * 36001 as v")
    found = {float(r.probability): r.value for r in quantiles_of(df, "v", (0.1, 0.5))}
    for p in (0.1, 0.5):
        place = p * 299_999
        assert float(found[p] - base) == pytest.approx(place * 36001, abs=0.01)


def test_equal_prices_lie_in_the_middle_bin(spark):
    df = spark.createDataFrame([(Decimal("9.50"),)] * 3, "price decimal(12,2)")
    rows = profiling.histogram(df).orderBy("bin").collect()
    assert [r.bin for r in rows if r.price_count] == [26]
    assert (rows[0].bin_start, rows[-1].bin_end) == (9.0, 10.0)


def test_weighted_quantiles_equal_repeated_rows(spark):
    df = spark.createDataFrame([(1, 5), (7, 90), (30, 6)], "v bigint, n bigint")
    rows = quantiles_of(df, "v", (0.5, 0.96), weight="n")
    expected = np.repeat([1, 7, 30], [5, 90, 6])
    assert {float(r.probability): float(r.value) for r in rows} == {
        p: pytest.approx(np.quantile(expected, p)) for p in (0.5, 0.96)
    }


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v bigint")
    assert quantiles_of(empty, "v", (0.5,)) == []


@pytest.mark.parametrize("up_to", [None, 0.9])
def test_histogram_matches_numpy(spark, up_to):
    cents = np.random.default_rng(5).integers(0, 40_000, 3000)
    df = spark.createDataFrame([(Decimal(int(c)) / 100,) for c in cents], "price decimal(12,2)")
    rows = profiling.histogram(df, 50, up_to).orderBy("bin").collect()
    kept = cents if up_to is None else cents[cents <= np.quantile(cents, up_to)]
    # Whole-number edges: scale so that bin limits are integers.
    low, high = int(kept.min()), int(kept.max())
    expected = np.bincount(np.minimum((kept - low) * 50 // (high - low), 49), minlength=50)
    assert [r.price_count for r in rows] == expected.tolist()
    assert rows[0].bin_start == low / 100 and rows[-1].bin_end == high / 100


def test_histogram_of_one_price(spark):
    df = spark.createDataFrame([(Decimal("3.00"),)] * 4, "price decimal(12,2)")
    counts = {r.bin: r.price_count for r in profiling.histogram(df).collect()}
    assert counts.pop(26) == 4 and set(counts.values()) == {0}


def test_session_sample_keeps_whole_sessions(spark):
    events = spark.range(20_000).select(
        F.concat(F.lit("s"), (F.col("id") % 2000).cast("string")).alias("user_session"), "id"
    )
    sample = profiling.session_sample(events)
    per_session = sample.groupBy("user_session").count().collect()
    assert 5 <= len(per_session) <= 45
    assert {r["count"] for r in per_session} == {10}
    assert sample.exceptAll(profiling.session_sample(events.repartition(3))).count() == 0


def test_random_sample_fraction_and_seed(spark):
    rows = spark.range(50_000)
    first = profiling.random_sample(rows)
    assert 350 < first.count() < 650
    assert first.exceptAll(profiling.random_sample(rows)).count() == 0


def test_approximate_cardinality_is_close(spark):
    names = profiling.CARDINALITIES.values()
    rows = spark.range(5000).selectExpr(*(f"id as {name}" for name in names))
    for row in profiling.cardinality(rows, approximate=True).collect():
        assert abs(row.value - 5000) < 500
