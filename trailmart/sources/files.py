"""Paths on whatever file system Spark is configured for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trailmart.session import shared_dir


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system behind ``path`` together with the parsed path."""
    jvm = spark._jvm
    parsed = jvm.org.apache.hadoop.fs.Path(path)
    return parsed.getFileSystem(spark._jsc.hadoopConfiguration()), parsed


def find_csv(spark: SparkSession, path: str) -> list[str]:
    """Every CSV file in a directory (or matching a glob), sorted; none is an error."""
    fs, parsed = file_system(spark, path)
    directory = fs.exists(parsed) and fs.getFileStatus(parsed).isDirectory()
    pattern = parsed.suffix("/*.csv") if directory else parsed
    paths = (str(status.getPath()) for status in fs.globStatus(pattern) or [])
    found = sorted(path for path in paths if path.endswith(".csv"))
    if not found:
        raise FileNotFoundError(f"no CSV file found in {path}")
    return found


def sizes_of(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Length in bytes of each file."""
    found = {}
    for path in paths:
        fs, parsed = file_system(spark, path)
        found[path] = int(fs.getFileStatus(parsed).getLen())
    return found


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: worked out once, whoever reads it how often.

    It is deleted when the innermost ``scratch`` around the call ends.
    """
    path = shared_dir(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what ``stored`` has written inside: results are to be consumed before."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            fs, parsed = file_system(spark, path)
            fs.delete(parsed, True)
