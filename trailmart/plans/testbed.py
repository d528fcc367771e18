"""Clickstream inputs derived from the generic ``events`` and ``part`` tables.

The mapping injects the irregularities the cleaning rules exist for: untrimmed and
upper-case types, types outside the funnel, missing prices, blank sessions, sessions
shared by two users, sessions that cross midnight, products without a master row and
master rows with blank or missing text. Every rule is deterministic and applied to
every row, so the same inputs can be derived in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmart.schemas import CATEGORY, LANDING_COLUMNS, MONEY, SOURCE_SYSTEM
from trailmart.session import configure


# Columns used here; a given schema spares a job that reads file footers.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_type string, p_brand string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _shaped(events: DataFrame) -> DataFrame:
    owner = "user_id - if(user_id % 50 = 1, 1, 0)"
    evening = "to_date(ts + interval 6 hours)"
    return events.selectExpr(
        "event_id",
        "cast(ts as timestamp) as event_time",
        "case event_type when 'click' then ' Cart ' when 'view' then 'VIEW' else event_type end as event_type",
        "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as product_id",
        f"if(event_id % 17 = 0, null, cast(value as {MONEY})) as price",
        "user_id",
        f"if(event_id % 13 = 0, '  ', concat('s', {owner}, '-', {evening})) as user_session",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(table(spark, sf_dir, "events")).selectExpr(
        "event_id",
        "event_time",
        "event_type",
        "product_id",
        f"cast(product_id % 10 as {CATEGORY}) as category_id",
        "price",
        "user_id",
        "user_session",
        "'events.parquet' as source_file",
        "current_timestamp() as loaded_at",
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "if(p_partkey % 11 = 0, null, p_partkey) as product_id",
        f"cast(p_partkey % 10 as {CATEGORY}) as category_id",
        *PRODUCT_TEXTS,
        f"'{SOURCE_SYSTEM}' as source_system",
        "current_timestamp() as loaded_at",
    )


PRODUCT_TEXTS = (
    "if(p_partkey % 7 = 0, '', p_type) as category_code",
    "if(p_partkey % 5 = 0, null, p_brand) as brand",
)

# Every n-th value of a column that does not parse, is missing, or is written unusually.
SPOILED = (
    ("event_time", 29, "'not a time'"),
    ("event_time", 47, "'12:30'"),
    ("product_id", 31, "'x12'"),
    ("product_id", 53, "concat(product_id, '.0')"),
    ("price", 37, "'n/a'"),
    ("event_type", 41, "null"),
    ("user_id", 43, "''"),
)
# Lines no loader may take apart: too few fields, too many, and one torn by a line break.
BROKEN_LINES = (
    (97, "array(concat('2019-10-01 00:00:00 UTC,view,', event_id))"),
    (101, "array(concat('2019-10-01 00:00:00 UTC,view,7,7,toys,acme,1.00,5,s', event_id, ',6,7,8'))"),
    (103, """array(concat('2019-10-01 00:00:00 UTC,view,7,7,toys,"two ', event_id),
        concat('lines",1.00,5,s', event_id))"""),
)


# A brand that only quotes hold together: line breaks, quotes and separators.
TORN_BRAND = """concat('big, "', coalesce({brand}, ''), '"\n,"II",\n\n x')"""


def landing(spark: SparkSession, sf_dir: str, dirty: bool, torn: bool = False) -> DataFrame:
    """Event rows as they would stand in a CSV: nine text columns after ``event_id``.

    A product's brand changes over time, so keeping the first one matters. ``dirty``
    adds values that do not parse, missing types and ids with a fraction of zero;
    ``torn`` adds brands with line breaks.
    """
    texts = table(spark, sf_dir, "part").selectExpr("p_partkey as product_id", *PRODUCT_TEXTS)
    rows = _shaped(table(spark, sf_dir, "events")).join(texts, "product_id", "left")
    text = {
        "event_time": "concat(date_format(event_time, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), ' UTC')",
        "event_type": "event_type",
        "product_id": "cast(product_id as string)",
        "category_id": "cast(product_id % 10 as string)",
        "category_code": "category_code",
        "brand": "if(event_id % 19 = 0, concat(brand, ' II'), brand)",
        "price": "cast(price as string)",
        "user_id": "cast(user_id as string)",
        "user_session": "nullif(trim(user_session), '')",
    }
    if torn:
        text["brand"] = f"if(event_id % 7 = 0, {TORN_BRAND.format(brand=text['brand'])}, {text['brand']})"
    if dirty:
        for name, n, bad in SPOILED:
            text[name] = f"if(event_id % {n} = 0, {bad}, {text[name]})"
    return rows.selectExpr("event_id", *(f"{text[name]} as {name}" for name in LANDING_COLUMNS))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as text, in one column named like the header they stand under."""
    lines = ", ".join(f"if(event_id % {n} = 0, {parts}, array())" for n, parts in BROKEN_LINES)
    rows = table(spark, sf_dir, "events").selectExpr(f"explode(concat({lines})) as line")
    return rows.withColumnRenamed("line", ",".join(LANDING_COLUMNS))
