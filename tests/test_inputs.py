"""Files that queries derive from the given tables: no task writes more of them as the tables grow."""

from __future__ import annotations

from collections import Counter

import pytest

from trailmart.plans import catalog
from trailmart.sources.files import find_csv


@pytest.fixture
def short_files(monkeypatch):
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    monkeypatch.setattr(catalog, "_written", {})


def lines_of(spark, folder):
    """Lines of each file, headers left out, in order of the paths."""
    return [spark.read.text(path).count() - 1 for path in find_csv(spark, folder)]


def test_parts_are_cut_and_in_order(spark, sf_dir, short_files):
    events = catalog.testbed.table(spark, sf_dir, "events").count()
    folder = catalog.csv_parts(spark, sf_dir, False)
    lines = lines_of(spark, folder)
    assert sum(lines) == events and len(lines) >= events / 100
    # Ranges are cut by a sample of the rows.
    assert lines[:2] == [50, 350] and max(lines[2:]) <= 200
    times = [r.event_time for path in find_csv(spark, folder) for r in spark.read.csv(path, header=True).collect()]
    wanted = catalog.testbed.landing(spark, sf_dir, False).orderBy("event_id").collect()
    assert times == [r.event_time for r in wanted]


def test_torn_files_are_cut(spark, sf_dir, short_files):
    folder = catalog.csv_torn(spark, sf_dir, False)
    number = len(find_csv(spark, folder))
    assert number >= catalog.testbed.table(spark, sf_dir, "events").count() / 100 - 1


@pytest.mark.parametrize("name", ["load_dense_keys", "append_load", "append_products", "product_master", "quoted_scan"])
def test_rows_do_not_depend_on_the_cut(spark, sf_dir, name, monkeypatch):
    found = []
    for rows in (100, 200_000):
        monkeypatch.setattr(catalog, "FILE_ROWS", rows)
        monkeypatch.setattr(catalog, "_written", {})
        result = catalog.QUERIES[name](spark, sf_dir)
        found.append(Counter(map(tuple, result.collect())))
    assert found[0] == found[1]
