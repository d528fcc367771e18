"""Properties of the physical plans that decide whether they hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from trailmart.operators import experiment, facts
from trailmart.plans import testbed
from trailmart.plans.catalog import QUERIES
from trailmart.plans.models import MODELS, Warehouse, derive
from trailmart.session import shared_dir
from trailmart.sources.tables import replace_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    target = Warehouse(spark, shared_dir(spark, "plans"))
    target.load("raw_events", testbed.raw_events(spark, sf_dir))
    target.load("product_dim", testbed.product_dim(spark, sf_dir))
    target.build()
    return target


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def built(warehouse, name):
    model = MODELS[name]
    return model.build(*(warehouse.read(source) for source in model.inputs))


@pytest.mark.parametrize("name", list(MODELS))
def test_models_stay_in_the_jvm_without_pairing_rows(spark, warehouse, name):
    text = plan(built(warehouse, name))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate", "SortAggregate"):
        assert operator not in text


def test_staging_reads_only_what_a_consumer_needs(warehouse):
    text = plan(warehouse.read("stg_events").groupBy("event_type").count())
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) <= {"event_time", "product_id", "user_id"}
    assert "IsNotNull(event_time)" in text and "IsNotNull(user_id)" in text


def test_conversions_read_purchase_files_only(warehouse):
    text = final_plan(facts.fact_conversions(warehouse.read("stg_events")))
    assert re.search(r"PartitionFilters: \[[^\]]*purchase", text)


def test_partition_pruning_on_conversion_days(warehouse):
    day = warehouse.read("fact_conversions").selectExpr("min(event_date) as d").first().d
    text = plan(warehouse.read("fact_conversions").filter(f"event_date = date '{day}'"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)


def test_user_join_adds_no_exchange(warehouse, no_broadcast):
    text = plan(built(warehouse, "dim_user"))
    assert text.count("SortMergeJoin") == 1
    # Two for the distinct counts of the events, one for the stored sessions.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


def test_experiment_from_sources_scans_the_events_twice(spark, sf_dir):
    sources = {"raw_events": testbed.raw_events(spark, sf_dir), "product_dim": testbed.product_dim(spark, sf_dir)}
    text = plan(derive("mart_experiment_results", sources))
    assert text.count("FileScan") == 2
    assert text.count("Join") == 1


def test_summary_is_evaluated_once_for_the_lift(warehouse):
    summary = experiment.variant_summary(
        experiment.user_metrics(warehouse.read("dim_user"), warehouse.read("fact_sessions"))
    )
    assert plan(experiment.lift_against_control(summary)).count("FileScan") == plan(summary).count("FileScan")


@pytest.mark.parametrize("name", ["fact_sessions", "fact_funnel_steps", "dim_user", "mart_revenue_attribution"])
def test_hot_keys_do_not_change_results(spark, warehouse, no_broadcast, name):
    """A third of all rows on one user, session and product; any partitioning, same rows."""
    raw = warehouse.read("raw_events").selectExpr(
        "event_id",
        "event_time",
        "event_type",
        "if(event_id % 3 = 0, 7, product_id) as product_id",
        "category_id",
        "price",
        "if(event_id % 3 = 0, 7, user_id) as user_id",
        "if(event_id % 3 = 0, 'hot', user_session) as user_session",
        "source_file",
        "loaded_at",
    )
    products = warehouse.read("product_dim")
    one = derive(name, {"raw_events": raw.coalesce(1), "product_dim": products})
    many = derive(name, {"raw_events": raw.repartition(13), "product_dim": products})
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


@pytest.fixture
def tiny_skew_limits(spark):
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def test_hot_product_is_split_when_products_are_not_broadcast(spark, warehouse, no_broadcast, tiny_skew_limits):
    hot = F.expr("if(conversion_id % 3 = 0, 7, product_id)")
    sold = warehouse.read("fact_conversions").withColumn("product_id", hot)
    stored = replace_table(sold.repartition(6), shared_dir(spark, "hot"))
    assert "skew=true" in final_plan(MODELS["mart_revenue_attribution"].build(stored, warehouse.read("dim_product")))


def test_scratch_folder_follows_the_session():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return "hdfs:///shared/" if key == "spark.checkpoint.dir" else default

    first, second = shared_dir(Session, "x"), shared_dir(Session, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_no_scratch_folder_on_a_cluster_without_setting():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:  # noqa: N801
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session, "x")


@pytest.mark.parametrize("name", ["cardinality", "metadata_quality"])
def test_distinct_counts_expand_no_rows(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text


def test_price_summary_reads_the_events_once(spark, sf_dir):
    text = QUERIES["price_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in text and "prices-" in text


def test_first_step_of_the_product_master_is_a_hash_aggregate(spark, sf_dir):
    text = QUERIES["product_master"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(load_order" in text
    assert [line for line in text.splitlines() if "partial_min(load_order" in line][0].lstrip(" +-:*(0123456789)").startswith("HashAggregate")
