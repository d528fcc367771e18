"""The table models, what each is built from, and a warehouse folder to build them in."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from trailmart.operators.dimensions import dim_date, dim_product, dim_user
from trailmart.operators.experiment import mart_experiment_results
from trailmart.operators.facts import fact_conversions, fact_funnel_steps, fact_sessions
from trailmart.operators.marts import mart_growth_daily, mart_revenue_attribution
from trailmart.operators.quality import check_table, check_tables, gate
from trailmart.operators.staging import stg_events
from trailmart.schemas import PRODUCT_DIM, RAW_EVENTS
from trailmart.session import configure
from trailmart.sources.extracts import export_csv
from trailmart.sources.tables import Manifest, Staged, current, discard_staged, publish, read_table, stage_table


@dataclass(frozen=True)
class Model:
    """A builder over the named inputs; a view stays lazy, a table is written once."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    schema: str
    is_view: bool = False
    partition_by: tuple[str, ...] = ()
    #: One row per day or per variant: small whatever the events, so its extract is one file.
    one_file: bool = False


SOURCES = ("raw_events", "product_dim")
SOURCE_PARTITIONS = {"raw_events": ("event_type",)}
CLUSTERED_BY = {"raw_events": ("event_time", "event_id")}
#: Models built at a time.
PARALLEL = 4
SCHEMAS = {"raw_events": RAW_EVENTS, "product_dim": PRODUCT_DIM}
MODELS = {
    "stg_events": Model(("raw_events",), stg_events, "staging", is_view=True),
    "fact_sessions": Model(("stg_events",), fact_sessions, "analytics"),
    "fact_funnel_steps": Model(("stg_events",), fact_funnel_steps, "analytics"),
    "fact_conversions": Model(("stg_events",), fact_conversions, "analytics", partition_by=("event_date",)),
    "dim_date": Model(("stg_events",), dim_date, "analytics"),
    "dim_product": Model(("product_dim",), dim_product, "analytics"),
    "dim_user": Model(("stg_events", "fact_sessions"), dim_user, "analytics"),
    "mart_growth_daily": Model(("fact_funnel_steps", "fact_conversions", "dim_date"), mart_growth_daily, "marts", one_file=True),
    "mart_revenue_attribution": Model(("fact_conversions", "dim_product"), mart_revenue_attribution, "marts"),
    "mart_experiment_results": Model(("dim_user", "fact_sessions"), mart_experiment_results, "marts", one_file=True),
}
MARTS = tuple(name for name, model in MODELS.items() if model.schema == "marts")


def with_inputs(names: Iterable[str]) -> list[str]:
    """The models ``names`` need, each after its inputs, in declaration order otherwise."""
    needed: list[str] = []
    for name in names:
        if name in MODELS and name not in needed:
            needed += [item for item in with_inputs(MODELS[name].inputs) if item not in needed]
            needed.append(name)
    return needed


def sources_of(name: str) -> tuple[str, ...]:
    """The source tables one model reads, directly or through other models."""
    read = {source for item in with_inputs([name]) for source in MODELS[item].inputs}
    return tuple(source for source in SOURCES if source in read)


def derive(name: str, sources: dict[str, DataFrame]) -> DataFrame:
    """One model as a lazy plan straight from the sources, nothing written."""
    frames = dict(sources)
    for item in with_inputs([name]):
        model = MODELS[item]
        frames[item] = model.build(*(frames[source] for source in model.inputs))
    return frames[name]


#: The ledger of a version from the rows written for it.
Ledger = Callable[[DataFrame], dict]


class Warehouse:
    """Models under one root folder, each table rebuilt completely and swapped in.

    Tables are read back after the write, so a consumer starts from files: a lost
    executor costs one table's tasks, never the chain of models before it.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        schema = MODELS[name].schema if name in MODELS else "raw"
        return f"{self.root}/{schema}/{name}"

    def load(
        self,
        name: str,
        rows: DataFrame,
        partition_by: tuple[str, ...] | None = None,
        tested: bool = False,
        ledger: Ledger | None = None,
    ) -> DataFrame:
        """Store a source table; the written rows keep their surrogate keys from here on.

        Raw events get a directory per event type, without a shuffle: a consumer of one
        type, such as conversions, then reads that type's files only, because partition
        pruning also works through the staging view's clean-up of the type.
        """
        if partition_by is None:
            partition_by = SOURCE_PARTITIONS.get(name, ())
        return self.publish(name, rows, partition_by, rebalance=False, tested=tested, ledger=ledger)

    def append(
        self,
        name: str,
        rows: DataFrame,
        ledger: Ledger,
        base: int,
        partition_by: tuple[str, ...] | None = None,
        tested: bool = False,
    ) -> DataFrame:
        """Add rows to a source table, with the ledger that says what they were loaded from.

        Rows and ledger are published together, and only if version ``base``, whose ledger
        decided what to load, is still current: a load that is repeated or meets another one
        adds nothing twice.
        """
        if partition_by is None:
            partition_by = SOURCE_PARTITIONS.get(name, ())
        return self.publish(name, rows, partition_by, rebalance=False, tested=tested, ledger=ledger, base=base)

    def version(self, name: str) -> Manifest:
        """The published version of a table with its ledger; number 0 for a table not there yet."""
        return current(self.spark, self.path(name)) or Manifest(0)

    def publish(
        self,
        name: str,
        rows: DataFrame,
        partition_by: tuple[str, ...],
        rebalance: bool = True,
        tested: bool = False,
        ledger: Ledger | None = None,
        base: int | None = None,
    ) -> DataFrame:
        """Write a new version of a table and switch to it, after its tests if asked for.

        With ``base`` the rows are added to that version. Rows that fail their tests are
        deleted; the version before stays in place.
        """
        written, staged = stage_table(rows, self.path(name), partition_by, rebalance)
        entries = None
        if base is not None:
            staged, entries = Staged(staged.entry, base), lambda old: (*old, staged.entry)
        try:
            if tested:
                gate(check_table(written, name))
            publish(self.spark, self.path(name), staged, entries, ledger(written) if ledger else {})
        except Exception:
            discard_staged(self.spark, self.path(name), staged)
            raise
        return written

    def read(self, name: str) -> DataFrame:
        """A stored table, or a view over the stored tables."""
        if name in MODELS and MODELS[name].is_view:
            model = MODELS[name]
            return model.build(*(self.read(source) for source in model.inputs))
        return read_table(self.spark, self.path(name), SCHEMAS.get(name))

    def build_one(self, name: str, tested: bool = False) -> DataFrame:
        """One model from the inputs as they are stored; a view has nothing to write."""
        model = MODELS[name]
        if model.is_view:
            rows = self.read(name)
            if tested:
                gate(check_table(rows, name))
            return rows
        rows = model.build(*(self.read(source) for source in model.inputs))
        return self.publish(name, rows, model.partition_by, tested=tested)

    def build(self, *names: str, tested: bool = False, parallel: int = PARALLEL) -> dict[str, DataFrame]:
        """Build the named models (all if none is named), each as soon as everything it needs is there.

        At most ``parallel`` models are built at a time, each in a scheduler pool of its own, so
        that with fair scheduling a short one does not wait for the tasks of a long one. With
        ``tested`` a model is published only if its declared tests pass. After a failure the
        models that need the failed one are left out, the others are still built, and
        the first failure is raised.
        """
        wanted = with_inputs(names or MODELS)
        waiting = {name: {item for item in MODELS[name].inputs if item in wanted} for name in wanted}
        built: dict[str, DataFrame] = {}
        failures: list[BaseException] = []

        def one(name: str) -> DataFrame:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"build-{name}")
            return self.build_one(name, tested)

        with ThreadPoolExecutor(max_workers=parallel) as workers:
            running: dict[Future, str] = {}
            while waiting or running:
                for name in [name for name, inputs in waiting.items() if inputs <= built.keys()]:
                    running[workers.submit(inheritable_thread_target(self.spark)(one), name)] = name
                    del waiting[name]
                if not running:
                    # What is left needs a model that has failed.
                    break
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(done)
                    if error := done.exception():
                        failures.append(error)
                    else:
                        built[name] = done.result()
        if failures:
            raise failures[0]
        return {name: built[name] for name in wanted}

    def cluster(self, name: str = "raw_events") -> DataFrame:
        """Rewrite a source table in order of time within its partitions, as a new version.

        Rows are dealt by ranges of (type, time, id): a file holds a stretch of time, so files
        and row groups of other days are skipped by their statistics, and a day with a large
        part of all events is spread over many files. The ledger stays with the rows.
        """
        version = self.version(name)
        by = [*SOURCE_PARTITIONS[name], *CLUSTERED_BY[name]]
        ordered = self.read(name).repartitionByRange(*by).sortWithinPartitions(*by)
        written, staged = stage_table(ordered, self.path(name), SOURCE_PARTITIONS[name], rebalance=False)
        try:
            publish(self.spark, self.path(name), Staged(staged.entry, version.number))
        except Exception:
            discard_staged(self.spark, self.path(name), staged)
            raise
        return written

    def create_views(self) -> None:
        """Make every stored table and view available to ``spark.sql`` under its name."""
        for name in (*SOURCES, *MODELS):
            self.read(name).createOrReplaceTempView(name)

    def test(self) -> DataFrame:
        """Results of all declared tests on the stored tables."""
        return check_tables({name: self.read(name) for name in (*SOURCES, *MODELS)})

    def export(self, folder: str) -> None:
        """CSV extracts of the marts."""
        for name in MARTS:
            export_csv(self.read(name), f"{folder}/{name}", single_file=MODELS[name].one_file)
