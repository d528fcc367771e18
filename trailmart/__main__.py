"""Command line: python -m trailmart COMMAND --warehouse DIR [...]

Runs on the session spark-submit or the Spark defaults configure.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from trailmart.operators import quality
from trailmart.plans import jobs
from trailmart.plans.models import Warehouse
from trailmart.sources.events import csv_header
from trailmart.sources.files import find_csv, scratch, sizes_of


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trailmart")
    parser.add_argument("--warehouse", required=True, help="root folder of the tables")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("validate", "load", "load-products", "append", "reload"):
        command = commands.add_parser(name)
        command.add_argument("csv", help="folder, file or glob of event CSV files")
        command.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    for name in ("load", "append"):
        commands.choices[name].add_argument("--permissive", action="store_true", help="keep any event type, set bad rows aside")
    commands.choices["reload"].add_argument("extracts", help="folder for the CSV extracts")
    commands.add_parser("build").add_argument("models", nargs="*", help="models to build, all if none is named")
    commands.add_parser("cluster", help="rewrite the raw events in order of time")
    profile = commands.add_parser("profile", help="exploration reports over the landed files")
    profile.add_argument("--approximate", action="store_true", help="estimate distinct counts from sketches")
    commands.add_parser("test")
    commands.add_parser("check")
    commands.add_parser("sql").add_argument("query", help="Spark SQL over the tables by name")
    commands.add_parser("export").add_argument("extracts", help="folder for the CSV extracts")
    given = parser.parse_args(argv)

    warehouse = Warehouse(SparkSession.builder.appName("trailmart").getOrCreate(), given.warehouse)
    if given.command == "reload":
        jobs.reload(warehouse, given.csv, given.extracts, given.multi_line)
    elif given.command in ("validate", "load", "load-products"):
        files = sizes_of(warehouse.spark, find_csv(warehouse.spark, given.csv))
        landing = jobs.land(warehouse, given.csv, given.multi_line)
        if given.command == "validate":
            jobs.validate(landing, csv_header(warehouse.spark, given.csv))
        elif given.command == "load":
            print("events:", jobs.load_events(warehouse, landing, given.permissive, files))
        else:
            print("products:", jobs.load_products(warehouse, landing, files))
    elif given.command == "append":
        for name, rows in jobs.append(warehouse, given.csv, given.permissive, given.multi_line).items():
            print(f"{name}: {rows} added")
    elif given.command == "build":
        print("built:", ", ".join(warehouse.build(*given.models, tested=True)))
    elif given.command == "cluster":
        warehouse.cluster()
    elif given.command == "profile":
        with scratch(warehouse.spark):
            for title, report in jobs.profile(warehouse, given.approximate).items():
                print(title)
                report.show(60, truncate=False)
    elif given.command == "test":
        results = warehouse.test()
        results.show(200, truncate=False)
        quality.gate(results)
    elif given.command == "check":
        for title, report in jobs.post_load_reports(warehouse).items():
            print(title)
            report.show(truncate=False)
    elif given.command == "sql":
        warehouse.create_views()
        warehouse.spark.sql(given.query).show(truncate=False)
    else:
        warehouse.export(given.extracts)


if __name__ == "__main__":
    main()
