"""Event CSV scan and the strict and permissive loads of raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.functions.text import category_or_null, empty_to_null, normalised, time_or_null, whole_or_null
from trailmart.schemas import CATEGORY, EVENT_TYPES, LANDING_COLUMNS, MONEY, REQUIRED
from trailmart.session import configure
from trailmart.sources import quoted
from trailmart.sources.files import find_csv, stored

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
BROKEN = "_broken_line"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file; only its first line is read."""
    return header_of(spark, find_csv(spark, path)[0])


def header_of(spark: SparkSession, file: str) -> list[str]:
    return spark.read.options(**CSV_OPTIONS).csv(file).columns


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False, files: list[str] | None = None) -> DataFrame:
    """All CSV files under ``path`` (or just ``files``) as text columns, where they stand, and broken lines.

    No value is converted or inferred here. Every file must carry the header of the
    first one. A line with another number of fields than the header is kept whole in
    ``malformed`` and has no other values. ``load_order`` follows file order within a
    split of a file, which ``file_start`` names; it costs no shuffle and has gaps. Line breaks
    inside quotes need ``multi_line``, which reads the files twice to find out where
    records begin; without it the parts of such a line are malformed. Large files are split
    either way.
    """
    configure(spark)
    files = find_csv(spark, path) if files is None else files
    header = header_of(spark, files[0])
    missing = [name for name in LANDING_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, BROKEN)])
    strictness = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    if multi_line:
        options = {**CSV_OPTIONS, **strictness, "header": "false"}
        read = quoted.records(spark, files, header)
        fields = ", ".join(f"`{name}` string" for name in schema.names)
        rows = read.select(
            F.from_csv("record", fields, options).alias("parsed"),
            F.expr("element_at(split(file_path, '/'), -1)").alias("source_file"),
            *("file_path", "file_start", "load_order"),
        ).select("parsed.*", "source_file", "file_path", "file_start", "load_order")
    else:
        # Pruned columns would hide wrong numbers of fields.
        options = {**CSV_OPTIONS, **strictness, "columnPruning": "false", "enforceSchema": "false"}
        rows = spark.read.schema(schema).options(**options).csv(files).select(
            "*",
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("file_start"),
            F.monotonically_increasing_id().alias("load_order"),
        )
    return rows.select(
        *(F.expr(f"if({BROKEN} is null, {name}, null) as {name}") for name in LANDING_COLUMNS),
        F.col(BROKEN).alias("malformed"),
        *("source_file", "file_path", "file_start", "load_order"),
    )


def numbered(rows: DataFrame, first: int) -> DataFrame:
    """``rows`` with ``load_order`` counted from ``first`` without gaps, by path of the file, then place in it.

    ``rows`` are read from files with no shuffle in between, so every task holds stretches
    of splits in order. One pass counts the rows of each stretch, running totals over this list
    (a row per stretch) say where each begins, and a second pass adds the place within the
    stretch. Rows are not moved: the list is stored, so Spark knows its size when it joins it.
    """
    placed = rows.select(
        "*",
        F.monotonically_increasing_id().alias("__at"),
        F.spark_partition_id().alias("__task"),
        F.input_file_name().alias("__input"),
        F.input_file_block_start().alias("__block"),
    )
    key = ["__task", "__input", "__block", "file_path", "file_start"]
    counts = placed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.min("__at").alias("__begin"), F.min("load_order").alias("__first")
    )
    before = F.sum("n").over(Window.orderBy("file_path", "file_start", "__first")) - F.col("n")
    list_ = stored(counts.select(*key, "__begin", before.alias("__before")), "stretches")
    number = F.col("__before") + F.col("__at") - F.col("__begin") + F.lit(first)
    return placed.join(list_, key).withColumn("load_order", number).select(*rows.columns)


def strict(name: str, target: str) -> Column:
    """Cast that fails the job on text the target type cannot hold, whatever the ANSI setting."""
    text = empty_to_null(name)
    value = time_or_null(text) if target == "timestamp" else f"try_cast({text} as {target})"
    failure = f"raise_error(concat('{name} is not a {target}: ', {name}))"
    return F.expr(f"coalesce({value}, if({text} is null, null, {failure})) as {name}")


def load_strict(landing: DataFrame, first_id: int | None = None) -> DataFrame:
    """Typed raw events, or an error: one bad value, line or negative price rejects the whole load.

    Rows without a required value or with a type outside the funnel are left out. Ids are
    the load order, or with ``first_id`` numbers from there on without gaps.
    """
    present = " and ".join(f"{empty_to_null(name)} is not null" for name in REQUIRED)
    wanted = f"{present} and {normalised('event_type')} in {EVENT_TYPES}"
    usable = landing.filter(f"if(malformed is null, {wanted}, raise_error(concat('malformed line: ', malformed)))")
    usable = usable if first_id is None else numbered(usable, first_id)
    cast = usable.select(
        F.col("load_order").alias("event_id"),
        strict("event_time", "timestamp"),
        F.expr(f"{normalised('event_type')} as event_type"),
        strict("product_id", "bigint"),
        strict("category_id", CATEGORY),
        strict("price", MONEY),
        strict("user_id", "bigint"),
        F.expr(f"{empty_to_null('user_session')} as user_session"),
        "source_file",
        F.current_timestamp().alias("loaded_at"),
    )
    return cast.withColumn("price", F.expr("if(price < 0, raise_error('price must not be negative'), price)"))


def typed(landing: DataFrame) -> DataFrame:
    """Every landing row with blanks and values that do not parse turned into NULL."""
    return landing.selectExpr(
        f"{time_or_null('event_time')} as event_time",
        f"{normalised('event_type')} as event_type",
        f"{whole_or_null('product_id')} as product_id",
        f"{category_or_null('category_id')} as category_id",
        *(f"{empty_to_null(name)} as {name}" for name in ("category_code", "brand")),
        f"try_cast(price as {MONEY}) as price",
        f"{whole_or_null('user_id')} as user_id",
        f"{empty_to_null('user_session')} as user_session",
        "source_file",
        "file_path",
        "file_start",
        "load_order",
    )


def load_permissive(landing: DataFrame, first_id: int | None = None) -> DataFrame:
    """Typed events that have all required values; event types are not restricted. Ids as in ``load_strict``."""
    complete = typed(landing).na.drop(subset=list(REQUIRED))
    complete = complete if first_id is None else numbered(complete, first_id)
    return complete.select(
        F.col("load_order").alias("event_id"),
        "event_time",
        "event_type",
        "product_id",
        "category_id",
        "price",
        "user_id",
        "user_session",
        "source_file",
        F.current_timestamp().alias("loaded_at"),
    )


def rejected(landing: DataFrame) -> DataFrame:
    """Text of the rows the permissive load leaves out, with the first column at fault."""
    reason = f"""case when malformed is not null then 'malformed'
        when {time_or_null("event_time")} is null then 'event_time'
        when {empty_to_null("event_type")} is null then 'event_type'
        when {whole_or_null("product_id")} is null then 'product_id'
        when {whole_or_null("user_id")} is null then 'user_id' end as reason"""
    return landing.selectExpr("*", reason).filter("reason is not null")
