"""Helpers several operators share."""

from __future__ import annotations

import gc
import string
import sys
import time
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.session import configure, shared_dir
from trailmart.sources.files import file_system

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of one Arrow batch: bounds what a Python worker holds of long texts.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}

#: Seconds the cleaner gets to notice what a garbage collection has freed.
PAUSE = 0.5


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that results and memory depend on."""
    configure(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def saved(df: DataFrame, label: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read back, with its path.

    Cuts the lineage: a lost executor costs the tasks that ran on it, not the job.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete finished intermediate tables."""
    for path in paths:
        fs, parsed = file_system(spark, path)
        fs.delete(parsed, True)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete finished intermediate tables and let Spark drop shuffles nobody refers to."""
    delete(spark, *paths)
    # The first collection lets go of plans, the next one of the shuffles they held.
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(PAUSE)


def one_row_each(docs: DataFrame, tie: Column, chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, tie) is in ``chosen``; of repeated such rows one.

    ``tie`` tells texts of equal ids apart. Rows move once, by that key.
    """

    def key(value) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), value.cast("string"))

    wanted = chosen.select(key(F.col("tie")).alias("__key"))
    keyed = docs.withColumn("__key", key(tie)).join(wanted.hint("merge"), "__key", "left_semi")
    number = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return keyed.withColumn("__number", number).where("__number = 1").select(*docs.columns)


def per_worker(name: str, make: Callable):
    """What ``make`` gives, made once per Python worker under ``name``.

    Functions travel to tasks by value and bring new globals each time; a module entry lasts.
    """
    kept = sys.modules.setdefault("trailmart_worker_state", ModuleType("trailmart_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


class Codes(dict):
    """Numbers words in order of appearance and lists those it has just met."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, word) -> int:
        self.fresh.append(word)
        self[word] = number = len(self)
        return number
