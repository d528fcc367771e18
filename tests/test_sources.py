"""CSV scan, loads, product master, table writes and extracts."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trailmart.operators import quality
from trailmart.sources import events, extracts, products, tables

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
COLUMNS = HEADER.split(",")
GOOD = "2019-10-01 00:00:00 UTC,view,1,2053013555631882655,electronics.phone,acme,9.99,5,s1"


@pytest.fixture
def csv(spark, tmp_path):
    def write(*lines, header=HEADER, name="events.csv"):
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
        return events.scan_csv(spark, str(tmp_path))

    return write


def test_scan_keeps_text_and_order(csv):
    rows = csv(
        GOOD,
        '2019-10-01 00:00:01 UTC, Cart ,2,,,"big, ""bold""",,6,',
        "2019-10-01 00:00:02 UTC,view,3,,\"\",b,1,7,s",
    ).orderBy("load_order").collect()
    assert [r.product_id for r in rows] == ["1", "2", "3"]
    assert rows[1].brand == 'big, "bold"'
    assert rows[1].event_type == " Cart "
    assert rows[1].category_id is None and rows[2].category_code is None
    assert {r.source_file for r in rows} == {"events.csv"}


def test_line_breaks_in_quotes_need_multi_line(spark, csv, tmp_path):
    csv(GOOD.replace("acme", '"two\nlines"'))
    row = events.scan_csv(spark, str(tmp_path), multi_line=True).first()
    assert row.brand == "two\nlines"


def test_all_files_are_read_and_none_is_an_error(spark, csv, tmp_path):
    csv(GOOD)
    (tmp_path / "notes.txt").write_text("not events")
    assert csv(GOOD, GOOD, name="more.csv").count() == 3
    with pytest.raises(FileNotFoundError):
        events.scan_csv(spark, str(tmp_path / "nothing"))


def test_missing_column_is_an_error_and_extra_one_is_not(spark, csv, tmp_path):
    with pytest.raises(ValueError, match="user_session"):
        csv("x", header=HEADER.replace(",user_session", ""))
    assert csv(GOOD + ",extra", header=HEADER + ",note").count() == 1
    assert quality.extra_columns(events.csv_header(spark, str(tmp_path))) == ["note"]


def test_headers_must_agree(csv):
    csv(GOOD)
    swapped = HEADER.replace("event_time,event_type", "event_type,event_time")
    with pytest.raises(Exception, match="header"):
        csv(GOOD, header=swapped, name="other.csv").collect()


def test_strict_load(csv):
    rows = events.load_strict(
        csv(
            GOOD,
            "2019-10-01 00:00:01 UTC, PURCHASE ,2,,,,,6,",
            "2019-10-01 00:00:01 UTC,signup,2,,,,,6,",
            ",view,2,,,,,6,",
            "2019-10-01 00:00:01 UTC,view,,,,,,6,",
        )
    ).orderBy("event_id").collect()
    assert [(r.event_type, r.user_id) for r in rows] == [("view", 5), ("purchase", 6)]
    assert str(rows[0].category_id) == "2053013555631882655"
    assert rows[1].price is None and rows[1].user_session is None


SHORT = ",".join(GOOD.split(",")[:6])
LONG = GOOD + ",7,8"
TORN = GOOD.replace("acme", '"two\nlines"')


@pytest.mark.parametrize("broken", [SHORT, LONG, TORN])
def test_broken_lines_are_kept_whole_and_stop_the_strict_load(csv, broken):
    landing = csv(GOOD, broken)
    assert sorted(r.malformed for r in landing.filter("malformed is not null").collect()) == sorted(broken.split("\n"))
    assert events.load_permissive(landing).count() == 1
    assert {r.reason for r in events.rejected(landing).collect()} == {"malformed"}
    with pytest.raises(PySparkException, match="malformed line"):
        events.load_strict(landing).collect()
    with pytest.raises(ValueError, match="line well_formed"):
        quality.validate_file(landing, COLUMNS)


def test_torn_lines_load_with_multi_line(spark, csv, tmp_path):
    csv(GOOD, TORN)
    landing = events.scan_csv(spark, str(tmp_path), multi_line=True)
    assert events.load_strict(landing).count() == 2


def test_ids_with_a_fraction_of_zero(csv):
    landing = csv(GOOD.replace(",1,", ",1.0,").replace(",5,", ",5.00,"), GOOD.replace(",1,", ",1.5,"))
    assert [(r.product_id, r.user_id) for r in events.load_permissive(landing).collect()] == [(1, 5)]
    assert [r.product_id for r in products.product_master(landing).collect()] == [1]
    assert [r.reason for r in events.rejected(landing).collect()] == ["product_id"]


@pytest.mark.parametrize("time", ["12:30", "2019", "2019-10"])
def test_part_of_a_time_is_no_time(csv, time):
    landing = csv(GOOD.replace("2019-10-01 00:00:00 UTC", time))
    assert events.load_permissive(landing).count() == 0
    with pytest.raises(PySparkException, match="event_time"):
        events.load_strict(landing).collect()


@pytest.mark.parametrize("split", ["4k", "128m"])
def test_first_product_row_does_not_depend_on_file_sizes(spark, csv, tmp_path, split):
    csv(*[GOOD.replace("acme", "first")] * 20, name="2019-10.csv")
    csv(*[GOOD.replace("acme", "second")] * 4000, name="2019-11.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = products.product_master(events.scan_csv(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.brand for r in rows] == ["first"]


def test_header_report(spark):
    report = quality.validate_header(spark, [*COLUMNS[1:], "note"])
    assert {(r.rule, r.column_name) for r in report.collect() if r.failures} == {("required_column", "event_time")}
    assert [r.column_name for r in report.filter("rule = 'extra_column'").collect()] == ["note"]


@pytest.mark.parametrize(
    "bad",
    [
        GOOD.replace("2019-10-01 00:00:00 UTC", "yesterday"),
        GOOD.replace(",1,", ",one,"),
        GOOD.replace("9.99", "-0.01"),
        GOOD.replace("9.99", "cheap"),
        GOOD.replace(",5,", ",5x,"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_load_rejects_everything_on_one_bad_value(spark, csv, tmp_path, bad, ansi):
    target = str(tmp_path / "raw")
    tables.replace_table(events.load_strict(csv(GOOD)), target)
    landing = csv(GOOD, GOOD, bad)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            tables.replace_table(events.load_strict(landing), target)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    # The table that was there before is still complete, and nothing is left beside it.
    assert tables.read_table(spark, target).count() == 1
    assert len([name for name in os.listdir(target) if name.startswith("__load=")]) == 1


def test_permissive_load_and_rejects_cover_every_row(csv):
    landing = csv(
        GOOD,
        GOOD.replace("view", "Signup"),
        GOOD.replace("9.99", "cheap"),
        GOOD.replace("2019-10-01 00:00:00 UTC", "yesterday"),
        GOOD.replace(",5,", ",,"),
        GOOD.replace("view", ""),
    )
    loaded = events.load_permissive(landing).orderBy("event_id").collect()
    assert [r.event_type for r in loaded] == ["view", "signup", "view"]
    assert loaded[2].price is None
    reasons = sorted(r.reason for r in events.rejected(landing).collect())
    assert reasons == ["event_time", "event_type", "user_id"]


def test_product_master_keeps_the_first_row_in_file_order(csv):
    landing = csv(
        GOOD,
        GOOD.replace("acme", "later").replace("2019-10-01", "2019-09-01"),
        GOOD.replace(",1,", ",2,").replace("acme", ""),
        GOOD.replace(",1,", ",2,"),
        GOOD.replace(",1,", ",x,"),
    )
    rows = {r.product_id: r for r in products.product_master(landing).collect()}
    assert {k: r.brand for k, r in rows.items()} == {1: "acme", 2: "unknown"}
    synced = products.sync_products(products.product_master(landing)).collect()
    assert {r.source_system for r in synced} == {"mysql_product_master"}


@pytest.mark.parametrize(("one_file", "parts"), [(True, 1), (False, 2)])
def test_extract_is_one_file_on_request(spark, tmp_path, one_file, parts):
    out = str(tmp_path / "out")
    names = ["January  ", 'a "quoted", name']
    mart = spark.createDataFrame([(n,) for n in names], "name string").repartition(2)
    extracts.export_csv(mart, out, single_file=one_file)
    assert len([name for name in os.listdir(out) if name.endswith(".csv")]) == parts
    back = spark.read.options(header="true", escape='"').csv(out)
    assert sorted(r.name for r in back.collect()) == sorted(names)


def test_validation_gate(spark, csv):
    good = csv(GOOD)
    quality.validate_file(good, COLUMNS)
    # Upper case passes the load but not the check of the file as written.
    with pytest.raises(ValueError, match="event_type accepted_values: 1"):
        quality.validate_file(csv(GOOD, GOOD.replace("view", "VIEW")), COLUMNS)
    with pytest.raises(ValueError, match="price not_null: 1"):
        quality.validate_file(csv(GOOD, GOOD.replace("9.99", "")), COLUMNS)
    with pytest.raises(ValueError, match="brand required_column"):
        quality.validate_file(good, [name for name in COLUMNS if name != "brand"])
    invalid = quality.invalid_event_types(csv(GOOD.replace("view", "VIEW"), GOOD)).collect()
    assert [(r.event_type, r.event_count) for r in invalid] == [("VIEW", 1)]
