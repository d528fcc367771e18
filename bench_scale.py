"""Build the whole warehouse on replicated events and time every table.

usage: bench_scale.py FOLDER [COPIES] [--hot] [--out DIR]

Each copy of an event gets its own event, user and session ids. ``--hot`` puts a third
of all events on one user, one session and one product. Prints one JSON line with
seconds, shuffles and Expand nodes per table. Tables go to DIR, by default a folder
below spark.checkpoint.dir. ``--compare`` also times models built one after the other and
together, distinct counts from events and from bitmaps, and a funnel of one day over raw
events as loaded and in order of time, with the bytes that the event log says were read.
"""

from __future__ import annotations

import argparse
import json
import os
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.operators import bitmaps
from trailmart.operators.facts import fact_funnel_steps
from trailmart.operators.staging import of_days
from trailmart.plans import testbed
from trailmart.plans.models import MODELS, Warehouse
from trailmart.session import local_session, shared_dir


def replicated(raw: DataFrame, copies: int, hot: bool) -> DataFrame:
    copied = raw.selectExpr("*", f"explode(sequence(0, {copies - 1})) as copy").selectExpr(
        "event_id * {0} + copy as event_id".format(copies),
        "event_time",
        "event_type",
        "product_id",
        "category_id",
        "price",
        "user_id * {0} + copy as user_id".format(copies),
        "if(trim(user_session) = '', user_session, concat(user_session, '-', copy)) as user_session",
        "source_file",
        "loaded_at",
    )
    if not hot:
        return copied
    third = "event_id % 3 = 0"
    changed = {"product_id": "7", "user_id": "7", "user_session": "'hot'"}
    return copied.selectExpr(
        *(f"if({third}, {changed[n]}, {n}) as {n}" if n in changed else n for n in copied.columns)
    )


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("folder")
    parser.add_argument("copies", nargs="?", type=int, default=1)
    parser.add_argument("--hot", action="store_true")
    parser.add_argument("--out")
    parser.add_argument("--compare", action="store_true")
    given = parser.parse_args()

    cores = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": str(4 * int(cores))}
    log = tempfile.mkdtemp(prefix="scale-log-") if given.compare else None
    if log:
        conf |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.scheduler.mode": "FAIR"}
    spark = local_session("scale", cores, conf)
    warehouse = Warehouse(spark, given.out or shared_dir(spark, "scale"))

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 2)

    raw = replicated(testbed.raw_events(spark, given.folder).repartition(int(cores)), given.copies, given.hot)
    seconds = {
        "raw_events": timed(lambda: warehouse.load("raw_events", raw)),
        "product_dim": timed(lambda: warehouse.load("product_dim", testbed.product_dim(spark, given.folder))),
    }
    shape = {}
    for name, model in MODELS.items():
        rows = model.build(*(warehouse.read(source) for source in model.inputs))
        text = rows._jdf.queryExecution().executedPlan().toString()
        shape[name] = {"exchanges": text.count("Exchange "), "expands": text.count("Expand ")}
        if not model.is_view:
            seconds[name] = timed(lambda name=name: warehouse.build_one(name))
    events = warehouse.read("raw_events").count()
    result = {"events": events, "hot": given.hot, "seconds": seconds, "plans": shape}
    if given.compare:
        result["compared"] = compared(spark, warehouse, timed)
    spark.stop()
    if log:
        result["megabytes_read"] = read_by_group(log)
    print(json.dumps(result))


def compared(spark, warehouse: Warehouse, timed) -> dict[str, float]:
    found = {}
    for parallel in (1, 4):
        found[f"models, {parallel} at a time"] = timed(lambda parallel=parallel: warehouse.build(parallel=parallel))

    def counted(period: str):
        rows = warehouse.read("stg_events").groupBy(F.expr(period).alias("period"))
        rows.agg(F.countDistinct("user_id"), F.countDistinct("user_session")).collect()

    found["distinct by day, from events"] = timed(lambda: counted("event_date"))
    found["distinct by month, from events"] = timed(lambda: counted("trunc(event_date, 'month')"))
    daily = []
    found["bitmaps of all days"] = timed(lambda: daily.append(bitmaps.stored_bitmaps(warehouse.read("stg_events"))))
    for name, period in (("day", "event_date"), ("month", "trunc(event_date, 'month')")):
        found[f"distinct by {name}, from bitmaps"] = timed(
            lambda period=period: bitmaps.distinct_per_period(daily[0], F.expr(period), "period").collect()
        )

    day = warehouse.read("stg_events").agg(F.expr("max(event_date) - 3").alias("d")).first().d

    def funnel(group: str):
        spark.sparkContext.setJobGroup(group, group)
        fact_funnel_steps(of_days(warehouse.read("raw_events"), day, day)).collect()
        spark.sparkContext.setJobGroup("other", "other")

    found["funnel of a day, as loaded"] = timed(lambda: funnel("as loaded"))
    found["ordering the raw events"] = timed(warehouse.cluster)
    found["funnel of a day, in order of time"] = timed(lambda: funnel("in order of time"))
    spark.sparkContext.setJobGroup("all days", "all days")
    fact_funnel_steps(warehouse.read("stg_events")).collect()
    return found


def read_by_group(log: str) -> dict[str, float]:
    """Megabytes that the tasks of each job group have read, from the event log."""
    groups, read = {}, {}
    for folder, _, names in os.walk(log):
        for name in sorted(names):
            if "appstatus" in name or name.endswith(".crc"):
                continue
            with open(os.path.join(folder, name)) as lines:
                for line in lines:
                    event = json.loads(line)
                    if event["Event"] == "SparkListenerJobStart":
                        group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                        groups |= {stage: group for stage in event["Stage IDs"]}
                    elif event["Event"] == "SparkListenerTaskEnd" and groups.get(event["Stage ID"]):
                        size = (event.get("Task Metrics") or {}).get("Input Metrics", {}).get("Bytes Read", 0)
                        group = groups[event["Stage ID"]]
                        read[group] = read.get(group, 0) + size / 1e6
    return {group: round(size, 2) for group, size in read.items()}


if __name__ == "__main__":
    main()
