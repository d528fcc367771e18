"""Dense keys, repeatable appends and torn lines across splits."""

from __future__ import annotations

import csv
import random

import pytest

from test_sources import COLUMNS, GOOD, HEADER
from trailmart.__main__ import main
from trailmart.plans import jobs
from trailmart.plans.models import Warehouse
from trailmart.sources import events, quoted, tables

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split(spark):
    before = spark.conf.get(SPLIT)
    yield lambda size: spark.conf.set(SPLIT, size)
    spark.conf.set(SPLIT, before)


def line(user, kind="view", product=1):
    return GOOD.replace(",5,", f",{user},").replace("view", kind).replace(",1,", f",{product},")


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.mark.parametrize("size", ["2k", "3001b", "128m"])
def test_dense_keys_follow_files_and_lines(spark, tmp_path, split, size):
    """The smaller file comes first by name, is packed with others by size, and loses rows to the filter."""
    write(tmp_path, "a.csv", [line(k, "signup" if k % 3 == 0 else "view") for k in range(40)])
    write(tmp_path, "b.csv", [line(k, "signup" if k % 5 == 0 else "cart") for k in range(100, 400)])
    write(tmp_path, "c.csv", [line(k) for k in range(500, 510)])
    split(size)
    loaded = events.load_strict(events.scan_csv(spark, str(tmp_path)), first_id=11)
    found = [(r.event_id, r.user_id) for r in loaded.orderBy("event_id").collect()]
    users = [k for k in range(40) if k % 3] + [k for k in range(100, 400) if k % 5] + [*range(500, 510)]
    assert found == list(enumerate(users, start=11))


def test_dense_keys_from_the_stored_text(spark, tmp_path, split):
    split("2k")
    write(tmp_path / "in", "a.csv", [line(k) for k in range(300)])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    landing = jobs.land(warehouse, str(tmp_path / "in"))
    split("700b")
    assert jobs.load_events(warehouse, landing) == 300
    found = [(r.event_id, r.user_id) for r in warehouse.read("raw_events").orderBy("event_id").collect()]
    assert found == [(k + 1, k) for k in range(300)]


def test_an_append_is_repeatable(spark, tmp_path):
    root, source = str(tmp_path / "wh"), tmp_path / "in"
    write(source, "2019-10.csv", [line(1), line(2, "cart", 7)])
    main(["--warehouse", root, "load", str(source)])
    main(["--warehouse", root, "load-products", str(source)])
    write(source, "2019-11.csv", [line(3, product=8), line(4, "signup"), line(5).replace("acme", "other")])
    warehouse = Warehouse(spark, root)
    assert jobs.append(warehouse, str(source)) == {"raw_events": 2, "product_master": 1, "product_dim": 1}
    assert jobs.append(warehouse, str(source)) == {"raw_events": 0, "product_master": 0, "product_dim": 0}
    events_ = sorted((r.event_id, r.user_id) for r in warehouse.read("raw_events").collect())
    assert events_ == [(1, 1), (2, 2), (3, 3), (4, 5)]
    brands = {r.product_id: r.brand for r in warehouse.read("product_dim").collect()}
    assert brands == {1: "acme", 7: "acme", 8: "acme"}
    with (source / "2019-10.csv").open("a") as more:
        more.write(line(9) + "\n")
    with pytest.raises(ValueError, match="changed since"):
        jobs.append(warehouse, str(source))


def test_a_failed_append_is_made_up_for(spark, tmp_path, monkeypatch):
    """Events are in, the products are not: the next call adds what is missing, nothing twice."""
    source = tmp_path / "in"
    write(source, "1.csv", [line(1)])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    jobs.append(warehouse, str(source))
    write(source, "2.csv", [line(2, product=3)])
    sync = jobs.products.sync_products
    monkeypatch.setattr(jobs.products, "sync_products", lambda master: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.append(warehouse, str(source))
    monkeypatch.setattr(jobs.products, "sync_products", sync)
    assert jobs.append(warehouse, str(source)) == {"raw_events": 0, "product_master": 0, "product_dim": 1}
    assert warehouse.read("raw_events").count() == warehouse.read("product_dim").count() == 2


def test_a_bad_file_adds_nothing(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "1.csv", [line(1)])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    jobs.append(warehouse, str(source))
    write(source, "2.csv", [line(2), line("x5")])
    with pytest.raises(Exception, match="user_id"):
        jobs.append(warehouse, str(source))
    assert warehouse.read("raw_events").count() == 1
    write(source, "2.csv", [line(2), line(5)])
    assert jobs.append(warehouse, str(source))["raw_events"] == 2
    assert sorted(r.event_id for r in warehouse.read("raw_events").collect()) == [1, 2, 3]


def test_an_append_that_meets_another_adds_nothing(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    write(source, "1.csv", [line(1)])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    jobs.append(warehouse, str(source))
    write(source, "2.csv", [line(2)])
    strict, calls = events.load_strict, []

    def meanwhile(*given):
        # Another writer loads the same file after this one has read the ledger.
        if not calls:
            calls.append(1)
            jobs.append(Warehouse(spark, warehouse.root), str(source))
        return strict(*given)

    monkeypatch.setattr(events, "load_strict", meanwhile)
    with pytest.raises(tables.StaleVersionError):
        jobs.append(warehouse, str(source))
    assert sorted(r.event_id for r in warehouse.read("raw_events").collect()) == [1, 2]


def test_permissive_append_keeps_rejects(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "wh")
    write(source, "1.csv", [line(1), line("x")])
    main(["--warehouse", root, "load", str(source), "--permissive"])
    write(source, "2.csv", [line(2, "look"), line("y"), line("z")])
    for _ in range(2):
        main(["--warehouse", root, "append", str(source), "--permissive"])
    warehouse = Warehouse(spark, root)
    assert sorted((r.event_id, r.event_type) for r in warehouse.read("raw_events").collect()) == [(1, "view"), (2, "look")]
    assert sorted(r.user_id for r in warehouse.read("rejected_events").collect()) == ["x", "y", "z"]


@pytest.mark.parametrize(
    ("text", "quoted_before", "expected"),
    [
        ("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a"b,c', False, False), ('"a""', False, True),
        ('"a"""', False, False), ('"","', False, True), ("b", True, True), ('b",c', True, False), ('b"",c', True, True),
        ('b","', True, True), ("", False, False), ("", True, True), ('"a"b,"c', False, True), ('"', True, False),
    ],
)
def test_state_after_a_line(text, quoted_before, expected):
    assert quoted.ends_quoted(text, quoted_before) is expected


def torn_file(path, rows, seed):
    rnd = random.Random(seed)
    texts = ["plain", 'say "hi"', "two\nlines", "\n\n", 'a,"\n"\n,b', "x" * 150 + "\n" + "y" * 150, "\r\nz", '"', ""]
    made = []
    for k in range(rows):
        row = dict(zip(COLUMNS, next(csv.reader([GOOD])), strict=True))
        row.update(user_id=str(k), brand=rnd.choice(texts), category_code=rnd.choice(["c", "\n".join(["long"] * rnd.choice([1, 40]))]))
        made.append(row)
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, COLUMNS, lineterminator="\n")
        writer.writeheader()
        writer.writerows(made)
    return [(r["user_id"], r["brand"] or None, r["category_code"]) for r in made]


@pytest.mark.parametrize("size", ["100b", "257b", "4k", "128m"])
def test_torn_lines_are_read_by_many_tasks(spark, tmp_path, split, size):
    """Records that cross one or many splits, in two files of different length."""
    expected = torn_file(tmp_path / "a.csv", 60, 1) + torn_file(tmp_path / "b.csv", 25, 2)
    split(size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        rows = events.scan_csv(spark, str(tmp_path), multi_line=True)
        found = [(r.user_id, r.brand, r.category_code) for r in rows.collect()]
        if size != "128m":
            assert quoted.lines(spark, [f"{tmp_path}/a.csv"]).rdd.getNumPartitions() > 2
        in_order = [r.user_id for r in rows.orderBy("source_file", "file_start", "load_order").collect()]
        assert rows.select("load_order").distinct().count() == len(expected)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert in_order == [user for user, *_ in expected]


def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, split):
    torn_file(tmp_path / "a.csv", 80, 3)
    with (tmp_path / "a.csv").open("a") as out:
        out.write(GOOD + ",too,many\n" + "too,few\n" + "\n" + GOOD.replace("acme", 'ac"me') + "\n" + GOOD.replace("acme", '"never closed'))
    split("400b")
    rows = events.scan_csv(spark, str(tmp_path), multi_line=True)
    schema = ", ".join(f"{name} string" for name in (*COLUMNS, events.BROKEN))
    whole = spark.read.schema(schema).options(**events.CSV_OPTIONS, multiLine="true", columnNameOfCorruptRecord=events.BROKEN)
    expected = whole.csv(str(tmp_path)).collect()
    good = sorted((tuple(r)[:-1] for r in expected if r[events.BROKEN] is None), key=str)
    found = rows.collect()
    assert sorted((tuple(r[name] for name in COLUMNS) for r in found if r.malformed is None), key=str) == good
    assert len(found) == len(expected)


def test_other_headers_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", [GOOD])
    (tmp_path / "b.csv").write_text(HEADER.replace("event_time,event_type", "event_type,event_time") + "\n" + GOOD + "\n")
    with pytest.raises(Exception, match="header"):
        events.scan_csv(spark, str(tmp_path), multi_line=True).collect()
