"""Table versions: what readers see, what failures leave, what two writers may do."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from trailmart.sources import tables
from trailmart.sources.files import scratch, stored


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


@pytest.fixture
def rows(spark):
    return spark.range(10).select("id", (F.col("id") % 3).alias("day"))


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(path):
    return sorted(name for name in os.listdir(path) if name.startswith(tables.LOAD))


def test_replace_append_and_partition_reload(spark, path, rows):
    tables.replace_table(rows, path, ("day",))
    tables.replace_table(rows, path, ("day",))
    assert tables.read_table(spark, path).count() == 10
    tables.append_table(rows.filter("day = 0"), path, ("day",))
    assert tables.read_table(spark, path).count() == 14
    assert tables.read_table(spark, path).columns == ["id", "day"]
    tables.replace_partitions(rows.filter("day = 0"), path, ("day",))
    assert ids(tables.read_table(spark, path)) == list(range(10))
    tables.replace_partitions(rows.filter("day = 7"), path, ("day",))
    assert ids(tables.read_table(spark, path, rows.schema)) == list(range(10))


def test_columns_come_in_the_order_of_a_given_schema(spark, path, rows):
    mixed = rows.select("day", "id")
    tables.replace_table(mixed, path, ("day",))
    assert tables.read_table(spark, path, mixed.schema).columns == ["day", "id"]


def test_a_version_is_read_only_once_it_is_published(spark, path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    old = tables.replace_table(spark.range(3), path)
    _, staged = tables.stage_table(spark.range(5), path)
    # A job lost between write and switch leaves the old version in place.
    assert tables.read_table(spark, path).count() == 3
    tables.publish(spark, path, staged)
    assert tables.read_table(spark, path).count() == 5
    # Readers that began with the version before can finish, older versions go.
    assert old.count() == 3
    for n in (7, 8):
        tables.replace_table(spark.range(n), path)
    assert tables.read_table(spark, path).count() == 8
    assert tables.numbers(spark, path) == [3, 4] and len(folders(path)) == 2


@pytest.mark.parametrize("change", ["append", "partitions", "replace"])
def test_a_reader_sees_the_old_rows_during_a_change(spark, path, rows, change):
    tables.replace_table(rows, path, ("day",))
    reader = tables.read_table(spark, path)
    if change == "append":
        tables.append_table(rows, path, ("day",))
    elif change == "partitions":
        tables.replace_partitions(rows.filter("id = 4"), path, ("day",))
    else:
        tables.replace_table(rows.filter("id = 4"), path, ("day",))
    # The same plan, executed anew, still finds all of its files.
    assert ids(reader) == list(range(10))
    expected = {"append": sorted([*range(10)] * 2), "partitions": [0, 2, 3, 4, 5, 6, 8, 9], "replace": [4]}
    assert ids(tables.read_table(spark, path)) == expected[change]


@pytest.mark.parametrize("write", [tables.append_table, tables.replace_table, tables.replace_partitions])
def test_a_failed_write_leaves_nothing(spark, path, rows, write):
    tables.replace_table(rows, path, ("day",))
    before, version = folders(path), tables.current(spark, path)
    broken = rows.selectExpr("if(id = 9, raise_error('broken'), id) as id", "day")
    with pytest.raises(Exception, match="broken"):
        write(broken, path, ("day",))
    assert folders(path) == before and tables.current(spark, path) == version
    assert ids(tables.read_table(spark, path)) == list(range(10))


def test_of_two_writers_with_one_base_the_second_is_refused(spark, path):
    tables.replace_table(spark.range(1), path)
    _, first = tables.stage_table(spark.range(2), path)
    _, second = tables.stage_table(spark.range(3), path)
    tables.publish(spark, path, first)
    with pytest.raises(tables.StaleVersionError):
        tables.publish(spark, path, second)
    # The staged folder of the other writer is its own business; what is published stays readable.
    assert tables.read_table(spark, path).count() == 2 and second.entry in folders(path)


def test_a_version_number_is_taken_once(spark, path):
    tables.replace_table(spark.range(1), path)
    version = tables.current(spark, path)
    with pytest.raises(tables.StaleVersionError):
        tables.commit(spark, path, tables.Manifest(version.number, ()))
    assert tables.current(spark, path) == version
    assert not [name for name in os.listdir(path) if name.startswith("_manifest")]


def test_appends_of_two_writers_both_stay(spark, path, monkeypatch):
    tables.replace_table(spark.range(2), path)
    stage, calls = tables.stage_table, []

    def slow(df, *given):
        written = stage(df, *given)
        if not calls:
            calls.append(1)
            # Another writer appends between the write and the switch.
            tables.append_table(spark.range(10, 12), path)
        return written

    monkeypatch.setattr(tables, "stage_table", slow)
    tables.append_table(spark.range(20, 22), path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 10, 11, 20, 21]


def test_the_ledger_goes_with_the_version(spark, path):
    tables.replace_table(spark.range(2), path)
    _, staged = tables.stage_table(spark.range(3), path)
    tables.publish(spark, path, staged, lambda old: (*old, staged.entry), {"files": {"a.csv": 5}})
    assert tables.current(spark, path).ledger == {"files": {"a.csv": 5}}
    tables.append_table(spark.range(1), path)
    assert tables.current(spark, path).ledger == {"files": {"a.csv": 5}}


def test_replaced_partitions_lose_their_files_later(spark, path, rows):
    tables.replace_table(rows, path, ("day",))
    first = folders(path)[0]
    for _ in range(3):
        tables.replace_partitions(rows.filter("day = 1"), path, ("day",))
    left = sorted(name for name in os.listdir(f"{path}/{first}") if name.startswith("day"))
    assert left == ["day=0", "day=2"] and len(folders(path)) == 3
    assert ids(tables.read_table(spark, path)) == list(range(10))


def test_scratch_tables_go_with_their_scope(spark):
    with scratch(spark):
        table = stored(spark.range(3), "x")
        where = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert table.count() == 3 and os.path.isdir(where)
    assert not os.path.exists(where)
