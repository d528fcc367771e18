"""Bitmaps, sketches, clustered events and the parallel build."""

from __future__ import annotations

import datetime
import threading
import time
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from events_data import Events, products
from trailmart.operators import bitmaps, sketches, staging
from trailmart.plans import models
from trailmart.plans.models import Warehouse

UTC = datetime.timezone.utc


@pytest.fixture
def staged(spark):
    events = Events()
    for day in range(28, 35):
        moment = datetime.datetime(2019, 9, 1) + datetime.timedelta(days=day)
        for user in range(day % 5 + 2):
            session = None if user == 0 else f"s{(day + user) % 4}"
            events.add(moment.isoformat(), "view", user=user * 10**12, session=session)
            events.add(moment.isoformat(), "cart", user=user * 10**12, session=session)
    return staging.stg_events(events.frame(spark))


def brute(staged, period):
    users, sessions = defaultdict(set), defaultdict(set)
    for r in staged.collect():
        users[period(r.event_date)].add(r.user_id)
        sessions[period(r.event_date)] |= {r.user_session} - {None}
    return {(p, len(users[p]), len(sessions[p])) for p in users}


def test_a_dictionary_numbers_values_without_gaps(spark):
    df = spark.range(1000).selectExpr("if(id % 7 = 0, null, concat('v', id % 300)) as v").repartition(9)
    rows = bitmaps.dictionary(df, "v").collect()
    assert sorted(r.id for r in rows) == list(range(1, 301)) and len({r.value for r in rows}) == 300
    assert bitmaps.dictionary(df.filter("v = 'none'"), "v").count() == 0


def test_days_and_months_from_the_same_bitmaps(spark, staged):
    stored = bitmaps.stored_bitmaps(staged)
    days = bitmaps.distinct_per_period(stored, bitmaps.F.col("event_date"), "day").collect()
    assert set(map(tuple, days)) == brute(staged, lambda day: day)
    months = bitmaps.distinct_per_period(stored, bitmaps.F.trunc("event_date", "month"), "month").collect()
    assert set(map(tuple, months)) == brute(staged, lambda day: day.replace(day=1))
    assert sum(r.active_users for r in months) < sum(r.active_users for r in days)


def test_more_numbers_than_one_bucket_holds(spark):
    rows = spark.range(100_000).selectExpr("date '2024-01-01' as event_date", "id as user_id", "cast(id % 70000 as string) as user_session")
    stored = bitmaps.stored_bitmaps(rows)
    assert stored.filter("counted = 'active_users'").count() == 4
    found = bitmaps.distinct_per_period(stored, bitmaps.F.col("event_date"), "day").first()
    assert (found.active_users, found.sessions) == (100_000, 70_000)


def test_merged_sketches_equal_one_pass(spark):
    names = sketches.CARDINALITIES.values()
    times = "timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id % 40 as int)) as event_time"
    rows = spark.range(60_000).selectExpr(times, *(f"(id * 7 + {k}) % 20000 as {name}" for k, name in enumerate(names)))
    daily = sketches.daily_sketches(rows)
    merged = {r.metric: r.value for r in sketches.estimates(daily).collect()}
    whole = rows.agg(*(sketches.F.expr(f"hll_sketch_estimate(hll_sketch_agg(cast({c} as string), 15)) as {n}") for n, c in sketches.CARDINALITIES.items()))
    for metric, value in whole.first().asDict().items():
        assert abs(merged[metric] - 20_000) <= 400 and abs(merged[metric] - value) <= 200
    by_month = sketches.estimates(daily, sketches.F.trunc("event_date", "month").alias("m")).collect()
    assert len(by_month) == 2 * len(merged)


@pytest.fixture
def warehouse(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path / "wh"))
    events = Events()
    for k in range(40):
        events.add(f"2024-01-{k % 9 + 1:02}T10:00:00", ("view", "cart", "purchase")[k % 3], user=k % 7, session=f"s{k % 11}", product=k % 4)
    target.load("raw_events", events.frame(spark))
    target.load("product_dim", products(spark, [(k, "c.d", "b") for k in range(4)]))
    return target


def test_clustered_events_skip_other_days(spark, tmp_path):
    """A hot day holds half of all events; other days are still read by a small part of the bytes."""
    target = Warehouse(spark, str(tmp_path / "wh"))
    day = "if(id % 2 = 0, 10, cast(id * 7919 % 30 as int))"
    raw = spark.range(60_000).selectExpr(
        "id as event_id", f"timestamp '2024-01-01' + make_interval(0, 0, 0, {day}, 0, cast(id % 1440 as int)) as event_time",
        "'view' as event_type", "id % 50 as product_id", "cast(1 as decimal(20,0)) as category_id", "cast(id % 999 as decimal(12,2)) as price",
        "id % 1000 as user_id", "concat('s', id % 5000) as user_session", "'f' as source_file", "current_timestamp() as loaded_at",
    )
    target.load("raw_events", raw.repartition(4), ledger=lambda _: {"files": {"f": 1}, "next_id": 9})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered = target.cluster()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert target.version("raw_events").ledger == {"files": {"f": 1}, "next_id": 9}
    names = [name for name in raw.columns if name != "loaded_at"]
    assert clustered.select(names).exceptAll(raw.select(names)).count() == 0 and clustered.count() == 60_000
    wanted = datetime.date(2024, 1, 22)
    start = datetime.datetime.combine(wanted, datetime.time())
    read = all_bytes = hot_files = 0
    for path in clustered.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
            times = columns["event_time"].statistics
            low, high = times.min.replace(tzinfo=None), times.max.replace(tzinfo=None)
            all_bytes += group.total_byte_size
            read += group.total_byte_size * (low < start + datetime.timedelta(days=1) and high >= start)
            hot_files += low.date() <= datetime.date(2024, 1, 11) <= high.date()
    assert read < 0.2 * all_bytes and hot_files >= 3
    days = staging.of_days(target.read("raw_events"), wanted, wanted)
    assert "GreaterThanOrEqual(event_time" in days._jdf.queryExecution().executedPlan().toString()
    assert days.count() == raw.filter("to_date(event_time) = date '2024-01-22'").count()


def test_independent_models_are_built_together(warehouse, monkeypatch):
    lock, running, most, spans = threading.Lock(), set(), [0], {}
    one = Warehouse.build_one

    def watched(self, name, tested=False):
        with lock:
            running.add(name)
            most[0] = max(most[0], len(running))
        begin = time.monotonic()
        try:
            return one(self, name, tested)
        finally:
            spans[name] = (begin, time.monotonic())
            with lock:
                running.discard(name)

    monkeypatch.setattr(Warehouse, "build_one", watched)
    built = warehouse.build(parallel=3, tested=True)
    assert list(built) == models.with_inputs(models.MODELS)
    assert 2 <= most[0] <= 3
    for name, model in models.MODELS.items():
        for item in model.inputs:
            assert item not in spans or spans[item][1] <= spans[name][0]
    rows = {name: sorted(map(str, built[name].drop("loaded_at").collect())) for name in built}
    again = warehouse.build(parallel=1)
    assert {name: sorted(map(str, again[name].drop("loaded_at").collect())) for name in again} == rows


def test_a_failure_leaves_out_its_dependents_only(warehouse, monkeypatch):
    def broken(*_):
        raise ValueError("no funnel")

    monkeypatch.setitem(models.MODELS, "fact_funnel_steps", models.Model(("stg_events",), broken, "analytics"))
    with pytest.raises(ValueError, match="no funnel"):
        warehouse.build()
    there = {name for name in models.MODELS if warehouse.version(name).number}
    assert there == set(models.MODELS) - {"stg_events", "fact_funnel_steps", "mart_growth_daily"}
