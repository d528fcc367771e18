"""The steps of a full reload: files in, tables built and tested, extracts out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trailmart.operators import checks, profiling, quality, sketches
from trailmart.plans.models import Ledger, Warehouse
from trailmart.schemas import LANDING_COLUMNS
from trailmart.sources import events, products
from trailmart.sources.files import find_csv, sizes_of, stored


def land(
    warehouse: Warehouse, csv_path: str, multi_line: bool = False, files: list[str] | None = None
) -> DataFrame:
    """Store the text of the files once; every later step reads it from there."""
    return warehouse.load("landing", events.scan_csv(warehouse.spark, csv_path, multi_line, files))


def validate(landing: DataFrame, header: list[str]) -> None:
    """Check the files as they are written; raises on the first failing stage."""
    quality.validate_file(landing, header)


def noted(files: dict[str, int], first_id: int | None = None) -> Ledger:
    """The ledger after a load of ``files``; with ``first_id`` also the next event id."""

    def ledger(written: DataFrame) -> dict:
        if first_id is None:
            return {"files": files}
        return {"files": files, "next_id": first_id + written.count()}

    return ledger


def load_events(
    warehouse: Warehouse, landing: DataFrame, permissive: bool = False, files: dict[str, int] | None = None
) -> int:
    """Replace the raw events with the landed rows, numbered from 1; returns the stored rows.

    The permissive load also keeps what it leaves out, as text with a reason. ``files`` are
    those the rows come from; later appends leave them out.
    """
    ledger = noted(files or {}, 1)
    if permissive:
        warehouse.load("rejected_events", events.rejected(landing), ledger=noted(files or {}))
        # Types are free text here, so they are no folder names.
        stored = warehouse.load("raw_events", events.load_permissive(landing, 1), partition_by=(), ledger=ledger)
    else:
        stored = warehouse.load("raw_events", events.load_strict(landing, 1), tested=True, ledger=ledger)
    return stored.count()


def load_products(warehouse: Warehouse, landing: DataFrame, files: dict[str, int] | None = None) -> int:
    """Extract the product master from the landed rows and sync it into the warehouse."""
    ledger = noted(files or {})
    master = warehouse.load("product_master", products.product_master(landing), ledger=ledger)
    return warehouse.load("product_dim", products.sync_products(master), ledger=ledger).count()


def files_to_load(name: str, known: dict[str, int], found: dict[str, int]) -> dict[str, int]:
    """Files of ``found`` that a table's ledger does not have; one that has changed since is an error."""
    changed = sorted(path for path, size in found.items() if known.get(path, size) != size)
    if changed:
        raise ValueError(f"files have changed since they were loaded into {name}: {changed}")
    return {path: size for path, size in found.items() if path not in known}


def append(warehouse: Warehouse, csv_path: str, permissive: bool = False, multi_line: bool = False) -> dict[str, int]:
    """Load those files into the existing tables that they have not got yet; rows added per table.

    Event ids go on from the highest one. Products already known keep their attributes.
    Each table has its own ledger, published with its rows, so after a failure the same
    call loads what is missing and nothing twice.
    """
    found = sizes_of(warehouse.spark, find_csv(warehouse.spark, csv_path))
    landed: dict[tuple[str, ...], DataFrame] = {}

    def landing_of(files: dict[str, int]) -> DataFrame:
        key = tuple(sorted(files))
        if key not in landed:
            landed[key] = land(warehouse, csv_path, multi_line, list(key))
        return landed[key]

    def unknown(master: DataFrame, name: str) -> DataFrame:
        known = warehouse.version(name).number > 0
        return master.join(warehouse.read(name).select("product_id"), "product_id", "left_anti") if known else master

    load = events.load_permissive if permissive else events.load_strict
    makers = {
        "raw_events": lambda landing, first_id: load(landing, first_id),
        "product_master": lambda landing, _: unknown(products.product_master(landing), "product_master"),
        "product_dim": lambda landing, _: products.sync_products(
            unknown(products.product_master(landing), "product_dim")
        ),
    }
    if permissive:
        makers["rejected_events"] = lambda landing, _: events.rejected(landing)
    added = {}
    for name, maker in makers.items():
        base = warehouse.version(name)
        known = base.ledger.get("files", {})
        files = files_to_load(name, known, found)
        if not files:
            added[name] = 0
            continue
        first_id = base.ledger.get("next_id", 1) if name == "raw_events" else None
        rows = maker(landing_of(files), first_id)
        tested = name == "raw_events" and not permissive
        written = warehouse.append(
            name, rows, noted({**known, **files}, first_id), base.number, () if permissive else None, tested
        )
        added[name] = written.count()
    return added


def post_load_reports(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Summaries of the stored sources, to be shown or written by the caller."""
    raw, master = warehouse.read("raw_events"), warehouse.read("product_dim")
    return {
        "total_events": checks.row_count(raw, "total_events"),
        "event_type_counts": checks.event_type_counts(raw),
        "date_range": checks.event_time_range(raw),
        "null_check": checks.null_counts(raw),
        "sample_events": checks.sample_rows(raw),
        "products": checks.unknown_products(master),
        "sample_products": checks.sample_rows(master),
    }


def profile(warehouse: Warehouse, approximate: bool = False) -> dict[str, DataFrame]:
    """Exploration reports over the landed files; consume them within ``scratch``.

    ``approximate`` estimates distinct counts from sketches per day instead of counting.
    """
    events_ = events.typed(warehouse.read("landing"))
    sessions = stored(profiling.session_profile(events_), "sessions")
    purchases = events_.filter("event_type = 'purchase'")
    if approximate:
        cardinality = sketches.estimates(stored(sketches.daily_sketches(events_), "sketches"))
    else:
        cardinality = profiling.cardinality(events_)
    return {
        "missing_values": profiling.missing_values(events_, LANDING_COLUMNS),
        "event_types": profiling.value_counts(events_, "event_type", "event_count", "event_pct"),
        "cardinality": cardinality,
        "daily_activity": profiling.daily_activity(events_).orderBy("event_date"),
        "top_categories": profiling.top_values(events_, "category_code"),
        "top_brands": profiling.top_values(events_, "brand"),
        "price_summary": profiling.price_summary(events_),
        "purchase_summary": profiling.purchase_summary(events_),
        "purchase_prices": profiling.histogram(purchases, up_to=0.99),
        "event_funnel": profiling.event_funnel(events_),
        "session_summary": profiling.session_summary_with_medians(sessions),
        "session_funnel": profiling.session_funnel_rates(sessions),
    }


def reload(warehouse: Warehouse, csv_path: str, extracts: str, multi_line: bool = False) -> None:
    """Everything in order; a failing check stops before anything later is published."""
    files = sizes_of(warehouse.spark, find_csv(warehouse.spark, csv_path))
    landing = land(warehouse, csv_path, multi_line)
    validate(landing, events.csv_header(warehouse.spark, csv_path))
    load_events(warehouse, landing, files=files)
    load_products(warehouse, landing, files)
    warehouse.build(tested=True)
    warehouse.export(extracts)
