"""Registered queries: every operator over the inputs derived from one data folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.operators import bitmaps, checks, experiment, marts, profiling, quality, sketches, staging
from trailmart.plans import jobs, testbed
from trailmart.plans.models import MODELS, SOURCES, Warehouse, derive, sources_of
from trailmart.schemas import LANDING_COLUMNS
from trailmart.session import shared_dir
from trailmart.sources import events, products
from trailmart.sources.extracts import export_csv
from trailmart.sources.files import find_csv, sizes_of, stored
from trailmart.sources.tables import append_table, read_table, replace_partitions, replace_table

Query = Callable[[SparkSession, str], DataFrame]

# Columns that name a load rather than describe an event.
LOAD_COLUMNS = ("source_file", "file_path", "file_start", "loaded_at")


def comparable(df: DataFrame) -> DataFrame:
    """Amounts as DOUBLE and category ids as BIGINT, without load-time columns."""
    kept = [field for field in df.schema.fields if field.name not in LOAD_COLUMNS]
    names = []
    for field in kept:
        decimal = isinstance(field.dataType, T.DecimalType)
        plain = "double" if decimal and field.dataType.scale else "bigint"
        names.append(f"cast({field.name} as {plain}) as {field.name}" if decimal else field.name)
    return df.selectExpr(*names)


def sources(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = SOURCES) -> dict[str, DataFrame]:
    readers = {"raw_events": testbed.raw_events, "product_dim": testbed.product_dim}
    return {name: readers[name](spark, sf_dir) for name in names}


def derived(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model as a lazy plan over the sources it needs."""
    return derive(name, sources(spark, sf_dir, sources_of(name)))


def model(name: str) -> Query:
    return lambda spark, sf_dir: comparable(derived(name, spark, sf_dir))


def over(name: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over one model."""
    return lambda spark, sf_dir: comparable(report(derived(name, spark, sf_dir)))


def over_raw(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(report(testbed.raw_events(spark, sf_dir)))


def over_landing(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over untyped rows, values that do not parse included."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = testbed.landing(spark, sf_dir, dirty=True).withColumnRenamed("event_id", "load_order")
        placed = "'landing' as source_file", "'landing' as file_path", "0L as file_start", "cast(null as string) as malformed"
        return comparable(report(text.selectExpr("*", *placed)))

    return run


def over_typed(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over rows with values that do not parse turned into NULL."""
    return over_landing(lambda text: report(events.typed(text)))


_written: dict[tuple, str] = {}

#: About the most rows of a written file, so that a task's share does not grow with the tables.
FILE_ROWS = 200_000


def files_of(spark: SparkSession, sf_dir: str) -> int:
    """Number of files that the events fill."""
    return max(1, -(-testbed.table(spark, sf_dir, "events").count() // FILE_ROWS))


def written_once(make: Callable[[SparkSession, str, bool], str]) -> Callable[[SparkSession, str, bool], str]:
    """Files derived from the given tables are inputs: one Spark application writes them once."""

    def folder(spark: SparkSession, sf_dir: str, dirty: bool) -> str:
        key = (make.__name__, spark.sparkContext.applicationId, sf_dir, dirty)
        if key not in _written:
            _written[key] = make(spark, sf_dir, dirty)
        return _written[key]

    return folder


@written_once
def csv_files(spark: SparkSession, sf_dir: str, dirty: bool) -> str:
    """A folder of CSV files with the derived rows; dirty ones hold broken lines too."""
    folder = shared_dir(spark, "landing")
    export_csv(testbed.landing(spark, sf_dir, dirty).select(*LANDING_COLUMNS), folder)
    if dirty:
        # Neither separators nor quotes mean anything to this writer: lines come out as they are.
        plain = {"header": "true", "sep": "\u0001", "quote": "\u0000"}
        testbed.broken_lines(spark, sf_dir).write.mode("append").options(**plain).csv(folder)
    return folder


@written_once
def csv_parts(spark: SparkSession, sf_dir: str, dirty: bool) -> str:
    """CSV files of unequal size, in order of the events: two short ones, the rest cut by ``FILE_ROWS``."""
    folder = shared_dir(spark, "parts")
    rows = testbed.landing(spark, sf_dir, dirty)
    # At least two for the rest: a union puts parts of one task each together task by task.
    numbers = (1, 1, max(2, files_of(spark, sf_dir)))
    kept = ("event_id < 50", "event_id >= 50 and event_id < 400", "event_id is null or event_id >= 400")
    parts = [
        rows.where(part).repartitionByRange(files, "event_id").sortWithinPartitions("event_id")
        for part, files in zip(kept, numbers, strict=True)
    ]
    # A union keeps the order of its parts, and files are numbered by task.
    ordered = parts[0].union(parts[1]).union(parts[2])
    export_csv(ordered.select(*LANDING_COLUMNS), folder)
    return folder


@written_once
def csv_torn(spark: SparkSession, sf_dir: str, dirty: bool) -> str:
    """CSV files, one per ``FILE_ROWS`` events, whose brands hold line breaks, quotes and separators."""
    folder = shared_dir(spark, "torn")
    rows = testbed.landing(spark, sf_dir, dirty, torn=True).repartition(files_of(spark, sf_dir), "event_id")
    export_csv(rows.select(*LANDING_COLUMNS), folder)
    return folder


def over_csv(report: Callable[[DataFrame], DataFrame], dirty: bool) -> Query:
    """A report over CSV files that were written from the derived rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(report(events.scan_csv(spark, csv_files(spark, sf_dir, dirty))))

    return run


def over_loaded(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over the stored table of a strict load."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        landed = stored(events.scan_csv(spark, csv_files(spark, sf_dir, dirty=False)), "landed")
        loaded = replace_table(events.load_strict(landed), shared_dir(spark, "loaded"), ("event_type",), rebalance=False)
        return report(loaded)

    return run


def over_parts(report: Callable[[DataFrame], DataFrame], dirty: bool = True) -> Query:
    """A report over CSV files of unequal size, in order of the events."""
    return lambda spark, sf_dir: comparable(report(events.scan_csv(spark, csv_parts(spark, sf_dir, dirty))))


def quoted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files with torn lines, each file read by many tasks."""
    folder = csv_torn(spark, sf_dir, False)
    size, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(size, "256k")
    try:
        read = stored(events.scan_csv(spark, folder, multi_line=True), "torn")
    finally:
        spark.conf.set(size, before)
    return comparable(read.drop("load_order"))


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after one file was loaded and the whole folder appended twice."""
    folder, warehouse = csv_parts(spark, sf_dir, False), Warehouse(spark, shared_dir(spark, "appended"))
    first = find_csv(spark, folder)[:1]
    landing = jobs.land(warehouse, folder, files=first)
    jobs.load_events(warehouse, landing, files=sizes_of(spark, first))
    jobs.load_products(warehouse, landing, sizes_of(spark, first))
    for _ in range(2):
        jobs.append(warehouse, folder)
    return comparable(warehouse.read("raw_events"))


def append_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product master after one file was loaded and the whole folder appended."""
    folder, warehouse = csv_parts(spark, sf_dir, False), Warehouse(spark, shared_dir(spark, "appended"))
    first = find_csv(spark, folder)[:1]
    landing = jobs.land(warehouse, folder, files=first)
    jobs.load_events(warehouse, landing, files=sizes_of(spark, first))
    jobs.load_products(warehouse, landing, sizes_of(spark, first))
    jobs.append(warehouse, folder)
    return comparable(warehouse.read("product_dim"))


def validate_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All file checks; the files have a column nobody expects."""
    folder = shared_dir(spark, "landing")
    rows = testbed.landing(spark, sf_dir, dirty=True).select(*LANDING_COLUMNS, F.lit("x").alias("note"))
    export_csv(rows, folder)
    header = quality.validate_header(spark, events.csv_header(spark, folder))
    return header.unionByName(quality.validate_landing(events.scan_csv(spark, folder)))


def extract(name: str) -> Query:
    """A mart as it reads back from its CSV extract."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_dir(spark, "extract")
        mart = replace_table(comparable(derived(name, spark, sf_dir)), shared_dir(spark, name))
        export_csv(mart, folder, single_file=MODELS[name].one_file)
        return spark.read.schema(mart.schema).options(header="true", escape='"').csv(folder)

    return run


def sample_of(source: str, columns: tuple[str, ...]) -> Query:
    """Size of a stored sample and rows in it that the source does not have."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = sources(spark, sf_dir, (source,))[source].select(*columns)
        return checks.sample_check(stored(checks.sample_rows(rows), "sample"), rows)

    return run


def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a one per cent sample has about its size, and rows in it the source lacks.

    Drawing rows independently stays within six standard deviations of the expected size.
    """
    rows = testbed.raw_events(spark, sf_dir).drop("loaded_at")
    sample = stored(profiling.random_sample(rows), "sample")
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    near = "abs(sample_rows - 0.01D * n) <= 6 * sqrt(0.01D * 0.99D * n)"
    return checks.sample_check(sample, rows).withColumn("n", size).selectExpr(f"{near} as size_fits", "not_in_source")


def per_user(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return derived("dim_user", spark, sf_dir), derived("fact_sessions", spark, sf_dir)


def experiment_user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(experiment.user_metrics(*per_user(spark, sf_dir)))


def experiment_variant_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(experiment.variant_summary(experiment.user_metrics(*per_user(spark, sf_dir))))


def filled_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A new warehouse in the shared folder with all sources and models built."""
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse"))
    for name, rows in sources(spark, sf_dir).items():
        warehouse.load(name, rows)
    warehouse.build()
    return warehouse


def warehouse_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after building every model in dependency order."""
    warehouse = filled_warehouse(spark, sf_dir)
    counts = [
        checks.row_count(warehouse.read(name)).select(F.lit(name).alias("table_name"), "total_rows")
        for name in (*SOURCES, *MODELS)
    ]
    report = counts[0]
    for count in counts[1:]:
        report = report.unionByName(count)
    return report


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared tests on freshly built tables."""
    return filled_warehouse(spark, sf_dir).test()


def table_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions after a truncate-and-reload, which must not double them, then counted."""
    path = shared_dir(spark, "reload")
    rows = derived("fact_conversions", spark, sf_dir)
    replace_table(rows, path, ("event_date",))
    reloaded = replace_table(rows, path, ("event_date",))
    return comparable(reloaded)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a table that already holds the purchases."""
    path = shared_dir(spark, "append")
    staged = derived("stg_events", spark, sf_dir)
    kept = replace_table(staged.filter("event_type = 'purchase'"), path)
    append_table(staged.filter("event_type <> 'purchase'"), path)
    return comparable(checks.event_type_counts(read_table(spark, path, kept.schema)))


def partition_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions per day after the days with priced purchases were written again."""
    path = shared_dir(spark, "partitions")
    rows = derived("fact_conversions", spark, sf_dir)
    kept = replace_table(rows, path, ("event_date",))
    replace_partitions(rows.filter("is_missing_revenue = 0"), path, ("event_date",))
    again = read_table(spark, path, kept.schema)
    return comparable(marts.daily_revenue(again))


def session_summary_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary reads the session rows several times, so they are stored once first."""

    def report(rows: DataFrame) -> DataFrame:
        return profiling.session_summary_with_medians(stored(profiling.session_profile(rows), "sessions"))

    return over_typed(report)(spark, sf_dir)


def distinct_by(period: Callable[[], Column], name: str) -> Query:
    """Distinct users and sessions per period from daily bitmaps that are stored first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        daily = bitmaps.stored_bitmaps(derived("stg_events", spark, sf_dir))
        return bitmaps.distinct_per_period(daily, period(), name)

    return run


def sketched_cardinality(events_: DataFrame) -> DataFrame:
    """Whether estimates of each month, from stored sketches of its days, are within two per cent of the counts."""
    month = F.trunc("event_date", "month").alias("event_month")
    estimated = sketches.estimates(stored(sketches.daily_sketches(events_), "sketches"), month)
    kept = profiling.CARDINALITIES
    exact = events_.groupBy(F.trunc(F.to_date("event_time"), "month").alias("month")).agg(
        *(F.countDistinct(column).alias(name) for name, column in kept.items())
    )
    cells = ", ".join(f"struct('{name}' as name, {name} as exact)" for name in kept)
    counted = exact.selectExpr("month", f"inline(array({cells}))")
    same = F.col("event_month").eqNullSafe(F.col("month")) & (F.col("metric") == F.col("name"))
    near = "abs(value - exact) <= 0.02D * exact as within_two_per_cent"
    return estimated.join(counted, same).selectExpr("event_month", "metric", "exact as value", near)


def clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type of the first three days, read from raw events in order of time."""
    warehouse = Warehouse(spark, shared_dir(spark, "clustered"))
    warehouse.load("raw_events", testbed.raw_events(spark, sf_dir))
    raw = warehouse.cluster()
    first = raw.agg(F.min(F.to_date("event_time")).alias("d")).first().d
    return checks.event_type_counts(staging.of_days(raw, first, first + datetime.timedelta(days=2)))


def without(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.drop(*names)


def purchases(df: DataFrame) -> DataFrame:
    return df.filter("event_type = 'purchase'")


def journeys(df: DataFrame) -> DataFrame:
    return profiling.value_counts(df, "journey_pattern", "session_count", "session_pct")


def segments(df: DataFrame) -> DataFrame:
    return profiling.value_counts(df, "user_segment", "user_count", "user_pct")


QUERIES: dict[str, Query] = {
    **{name: model(name) for name in MODELS},
    # marts: reports
    "top_category_brand": over("mart_revenue_attribution", marts.top_category_brands),
    "top_attribution_rows": over("mart_revenue_attribution", marts.top_attribution_rows),
    "attribution_row_count": over("mart_revenue_attribution", checks.row_count),
    "distinct_by_day": distinct_by(lambda: F.col("event_date"), "event_date"),
    "distinct_by_month": distinct_by(lambda: F.trunc("event_date", "month"), "event_month"),
    "clustered_days": clustered_days,
    "daily_revenue": over("fact_conversions", marts.daily_revenue),
    "journey_distribution": over("fact_sessions", journeys),
    "user_segments": over("dim_user", segments),
    # experiment steps
    "experiment_assignment": over("dim_user", experiment.assign_variants),
    "experiment_user_metrics": experiment_user_metrics,
    "experiment_variant_summary": experiment_variant_summary,
    # loading
    "csv_scan": over_csv(without("load_order"), dirty=True),
    "load_strict": over_csv(lambda text: events.load_strict(text).drop("event_id"), dirty=False),
    "load_permissive": over_csv(lambda text: events.load_permissive(text).drop("event_id"), dirty=True),
    "load_rejected": over_csv(lambda text: events.rejected(text).drop("load_order"), dirty=True),
    "load_row_count": over_loaded(checks.row_count),
    "surrogate_keys": over_loaded(
        lambda stored: stored.agg(
            F.count(F.lit(1)).alias("total_rows"), F.countDistinct("event_id").alias("distinct_keys")
        )
    ),
    "load_dense_keys": over_parts(lambda text: events.load_strict(text, first_id=1), dirty=False),
    "append_load": append_load,
    "append_products": append_products,
    "quoted_scan": quoted_scan,
    "product_master": over_parts(products.product_master),
    "product_sync": over_parts(lambda text: products.sync_products(products.product_master(text))),
    "table_reload": table_reload,
    "table_append": table_append,
    "partition_reload": partition_reload,
    "mart_extract": extract("mart_growth_daily"),
    "extract_attribution": extract("mart_revenue_attribution"),
    "extract_experiment": extract("mart_experiment_results"),
    "warehouse_build": warehouse_build,
    # quality
    "dq_results": dq_results,
    "validate_landing": validate_landing,
    "invalid_event_types": over_landing(quality.invalid_event_types),
    "raw_event_type_counts": over_raw(checks.event_type_counts),
    "raw_time_range": over_raw(checks.event_time_range),
    "raw_null_counts": over_raw(checks.null_counts),
    "raw_sample_rows": sample_of("raw_events", ("event_id", "event_time", "event_type", "product_id", "user_id")),
    "unknown_products": over("dim_product", checks.unknown_products),
    "product_sample_rows": sample_of("product_dim", ("product_id", "category_id", "category_code", "brand")),
    # profiling
    "missing_values": over_typed(lambda df: profiling.missing_values(df, LANDING_COLUMNS)),
    "metadata_quality": over_typed(profiling.metadata_quality),
    "event_type_distribution": over_typed(
        lambda df: profiling.value_counts(df, "event_type", "event_count", "event_pct")
    ),
    "time_profile": over_landing(profiling.time_profile),
    "daily_activity": over_typed(profiling.daily_activity),
    "cardinality": over_typed(profiling.cardinality),
    "cardinality_sketched": over_typed(sketched_cardinality),
    "top_categories": over_typed(lambda df: profiling.top_values(df, "category_code")),
    "top_brands": over_typed(lambda df: profiling.top_values(df, "brand")),
    "price_summary": over_typed(profiling.price_summary),
    "purchase_summary": over_typed(profiling.purchase_summary),
    "price_histogram": over_typed(lambda df: profiling.histogram(purchases(df))),
    "price_histogram_p99": over_typed(lambda df: profiling.histogram(purchases(df), up_to=0.99)),
    "event_funnel": over_typed(profiling.event_funnel),
    "event_funnel_rates": over_typed(profiling.event_funnel_rates),
    "session_profile": over_typed(profiling.session_profile),
    "session_summary": over_typed(lambda df: profiling.session_summary(profiling.session_profile(df))),
    "session_summary_medians": session_summary_medians,
    "session_funnel_rates": over_typed(lambda df: profiling.session_funnel_rates(profiling.session_profile(df))),
    "session_hash_sample": over_typed(lambda df: profiling.session_sample(df).drop("load_order")),
    "random_sample": random_sample,
}
