"""Declared tests, row checks and the warehouse they run on."""

from __future__ import annotations

import pytest

from events_data import Events, products
from trailmart.operators import quality
from trailmart.plans.models import MODELS, Warehouse, sources_of, with_inputs


def failures(results):
    return {(r.table_name, r.rule, r.column_name): r.failures for r in results.collect() if r.failures}


def test_hundred_column_tests_are_declared():
    counts = {"not_null": 0, "unique": 0, "accepted_values": 0}
    for declared in quality.COLUMN_TESTS.values():
        for rule, columns in declared.items():
            counts[rule] += len(columns)
    assert counts == {"not_null": 71, "unique": 10, "accepted_values": 19}


def test_each_rule_counts_its_violations(spark):
    events = (
        Events()
        .add("2024-03-03T10:00:00", "view", price="-1.00")
        .add("2024-03-03T10:00:00", "click")
        .add("2024-03-03T10:00:00", "cart", price=None)
    )
    rows = events.frame(spark)
    doubled = rows.unionByName(rows.filter("event_type = 'cart'"))
    assert failures(quality.check_table(doubled, "raw_events")) == {
        ("raw_events", "accepted_values", "event_type"): 1,
        ("raw_events", "check", "event_type"): 1,
        ("raw_events", "check", "price"): 1,
        ("raw_events", "unique", "event_id"): 1,
    }


def test_null_is_neither_duplicate_nor_unaccepted(spark):
    rows = products(spark, [(None, "a", "b"), (None, "a", "b"), (1, None, "b")])
    assert failures(quality.check_table(rows, "product_dim")) == {
        ("product_dim", "not_null", "product_id"): 2,
        ("product_dim", "not_null", "category_code"): 1,
    }


@pytest.mark.parametrize("planted", [[], [(5, 1)], [(5, 3), (70_000, 1), (-9, 2), (1 << 40, 1)]])
def test_numbered_keys_are_checked_by_bitmaps(spark, tmp_path, planted):
    """Duplicates inside a file and across files, far apart and next to each other."""
    ids = spark.range(-100, 100_000).unionByName(spark.range(1 << 40, (1 << 40) + 10))
    rows = ids.selectExpr("id as event_id").repartition(4, "event_id")
    for value, times in planted:
        for _ in range(times):
            rows = rows.unionByName(spark.range(value, value + 1).selectExpr("id as event_id"))
    rows.unionByName(spark.createDataFrame([(None,), (None,)], "event_id long")).write.parquet(f"{tmp_path}/t")
    report = quality.duplicated_numbers(spark.read.parquet(f"{tmp_path}/t"), "t", "event_id")
    assert [tuple(r) for r in report.collect()] == [("t", "unique", "event_id", len(planted))]
    text = report._jdf.queryExecution().executedPlan().toString()
    assert ("hashpartitioning(event_id" in text) == bool(planted)


def test_gate_names_what_failed(spark):
    good = products(spark, [(1, "a", "b")])
    quality.gate(quality.check_table(good, "product_dim"))
    with pytest.raises(ValueError, match="product_dim.product_id unique: 1"):
        quality.gate(quality.check_table(good.union(good), "product_dim"))


@pytest.fixture
def warehouse(spark, tmp_path):
    events = (
        Events()
        .add("2024-03-03T10:00:00", "view", user=1, session="a", product=1)
        .add("2024-03-03T10:05:00", "purchase", user=1, session="a", product=1)
        .add("2024-03-05T10:00:00", "cart", user=2, session="b", product=2)
    )
    target = Warehouse(spark, str(tmp_path))
    target.load("raw_events", events.frame(spark))
    target.load("product_dim", products(spark, [(1, "toys", "acme"), (2, "toys", "zeta")]))
    return target


def test_models_follow_their_inputs():
    order = with_inputs(MODELS)
    for name, model in MODELS.items():
        for source in model.inputs:
            assert source not in MODELS or order.index(source) < order.index(name)
    assert with_inputs(["dim_product"]) == ["dim_product"]
    assert with_inputs(["mart_experiment_results"]) == [
        "stg_events",
        "fact_sessions",
        "dim_user",
        "mart_experiment_results",
    ]
    assert sources_of("dim_product") == ("product_dim",)


def test_clean_warehouse_passes_every_test(warehouse):
    warehouse.build()
    results = warehouse.test()
    assert failures(results) == {}
    # 100 column tests and 2 row checks.
    assert results.count() == 102
    quality.gate(results)


def test_single_model_build_and_rebuild(spark, warehouse):
    built = warehouse.build("dim_product")
    assert list(built) == ["dim_product"] and built["dim_product"].count() == 2
    warehouse.build()
    warehouse.build()
    assert warehouse.read("fact_sessions").count() == 2
    assert warehouse.read("dim_date").count() == 3
    assert warehouse.read("mart_growth_daily").count() == 2


def test_extracts(spark, warehouse, tmp_path):
    warehouse.build()
    warehouse.export(str(tmp_path / "extracts"))
    growth = spark.read.options(header="true").csv(str(tmp_path / "extracts" / "mart_growth_daily"))
    assert len(growth.columns) == 34 and growth.count() == 2


def test_marts_agree_with_each_other(warehouse):
    warehouse.build()
    total = {
        name: warehouse.read(name).selectExpr("sum(total_revenue) as t", "sum(purchase_events) as p").first()
        for name in ("mart_growth_daily", "mart_revenue_attribution", "mart_experiment_results")
    }
    assert len({(row.t, row.p) for row in total.values()}) == 1
    days = warehouse.read("mart_growth_daily")
    assert days.filter("view_events + cart_events + purchase_events <> total_events").count() == 0
    assert days.filter("funnel_purchase_events <> purchase_events").count() == 0
    assert days.filter("sessions_with_purchase <> purchasing_sessions").count() == 0
