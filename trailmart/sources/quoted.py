"""Records of CSV files whose quoted fields may hold line breaks, read by many tasks per file.

Files are read as lines, which Spark splits anywhere. A line break belongs to a record if it
lies inside quotes, which only what stands before it can tell. So each split is first looked at
alone: does its text end inside quotes if it begins outside, and if it begins inside? Going
through the splits of a file in order then says how each begins. A second pass puts lines
together; only records that go on in another split are assembled by a grouping.
"""

from __future__ import annotations

import csv
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions that run in tasks travel with their code, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATOR, QUOTE = ",", '"'
WHOLE, FRAGMENT = 0, 1


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether a line ends inside quotes, given whether it begins there.

    Quotes count at the beginning of a field only; doubled ones inside do not end it.
    """
    at = 0
    while True:
        if quoted:
            at = line.find(QUOTE, at)
            while at >= 0 and line.startswith(QUOTE, at + 1):
                at = line.find(QUOTE, at + 2)
            if at < 0:
                return True
            quoted = False
        elif line.startswith(QUOTE, at):
            quoted, at = True, at + 1
            continue
        at = line.find(SEPARATOR, at)
        if at < 0:
            return False
        at += 1


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line with its file and the place where its split begins, in order within a split."""
    read = spark.read.option("lineSep", "\n").text(paths)
    return read.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_start"),
    )


def stretches(batches):
    """(file_path, file_start, values) of each split within each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column("file_path"), batch.column("file_start")
        same = [pc.equal(column.slice(1), column.slice(0, batch.num_rows - 1)) for column in (paths, starts)]
        cuts = pc.indices_nonzero(pc.invert(pc.and_(*same))).to_pylist()
        bounds = [0, *(cut + 1 for cut in cuts), batch.num_rows]
        for low, high in zip(bounds, bounds[1:], strict=False):
            yield paths[low].as_py(), starts[low].as_py(), batch.column("value").slice(low, high - low)


def states(text: DataFrame) -> DataFrame:
    """Per split: whether it ends inside quotes if it begins outside or inside, and whether a record ends in the latter."""

    def look(batches):
        found: dict[tuple, list[bool]] = {}
        for path, start, values in stretches(batches):
            state = found.setdefault((path, start), [False, True, False])
            for line in values.filter(pc.match_substring(values, QUOTE)).to_pylist():
                plain, quoted, _ = state
                state[0] = ends_quoted(line, plain)
                state[1] = state[0] if plain == quoted else ends_quoted(line, quoted)
                state[2] = state[2] or not state[1]
        rows = [(path, start, *state) for (path, start), state in found.items()]
        names = ["file_path", "file_start", "plain", "quoted", "ends"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return text.mapInArrow(look, "file_path string, file_start long, plain boolean, quoted boolean, ends boolean")


def beginnings(found: list) -> tuple[dict[tuple[str, int], tuple[str, int]], bool]:
    """For each split that begins inside quotes, the split where that record begins; whether any split ends inside."""
    inside: dict[tuple[str, int], tuple[str, int]] = {}
    path, quoted, origin, open_ = None, False, None, False
    for row in sorted(found, key=lambda row: (row.file_path, row.file_start)):
        here = (row.file_path, row.file_start)
        if row.file_path != path:
            path, quoted, origin = row.file_path, False, here
        if quoted:
            inside[here] = origin
        if not quoted or row.ends:
            origin = here
        quoted = row.quoted if quoted else row.plain
        open_ = open_ or quoted
    return inside, open_


RECORD_SCHEMA = "kind int, record string, file_path string, file_start long, load_order long, position long"


def joined_lines(text: DataFrame, inside: dict[tuple[str, int], tuple[str, int]], header: list[str]) -> DataFrame:
    """Whole records of each split without headers, and fragments of those that cross splits.

    A fragment carries the split where its record begins; the first one also has the place
    of the record in the order of loading.
    """

    def join(batches):
        from pyspark import TaskContext

        order = TaskContext.get().partitionId() << 33
        split, waiting, quoted, first, foreign = None, [], False, False, False
        rows: list[tuple] = []

        def fragment(record: str) -> tuple:
            return (FRAGMENT, record, *(inside[split] if foreign else split), None if foreign else order, split[1])

        def batch_of(rows):
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for path, start, values in stretches(batches):
            if (path, start) != split:
                if waiting:
                    # What is still open when a split ends goes on in the next one.
                    rows.append(fragment("\n".join(waiting)))
                order += 1
                split, waiting, first = (path, start), [], start == 0
                quoted = foreign = split in inside
            marked = pc.match_substring(values, QUOTE).to_pylist()
            for line, has_quote in zip(values.to_pylist(), marked, strict=True):
                quoted = ends_quoted(line, quoted) if has_quote else quoted
                waiting.append(line)
                if quoted:
                    continue
                record, waiting = "\n".join(waiting), []
                if foreign:
                    rows.append(fragment(record))
                    foreign = False
                elif first:
                    first = False
                    if next(csv.reader([record.removesuffix("\r")])) != header:
                        raise ValueError(f"the header of {path} is not that of the first file")
                elif record.strip():
                    rows.append((WHOLE, record, path, start, order, None))
                    order += 1
            if len(rows) >= 10_000:
                yield batch_of(rows)
                rows = []
        if waiting:
            rows.append(fragment("\n".join(waiting)))
        if rows:
            yield batch_of(rows)

    return text.mapInArrow(join, RECORD_SCHEMA)


def records(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """record, file_path, file_start, load_order of every record of the files, headers left out.

    Order follows the file within a split. A quote that is never closed makes one record of
    the rest of its file.
    """
    text = lines(spark, paths)
    inside, open_ = beginnings(states(text).collect())
    joined = joined_lines(text, inside, header)
    columns = ("record", "file_path", "file_start", "load_order")
    whole = joined.where(f"kind = {WHOLE}").select(*columns)
    if open_:
        # Few: one record for each border of splits that lies inside quotes.
        ordered = "array_sort(collect_list(struct(position, record)))"
        parts = joined.where(f"kind = {FRAGMENT}").groupBy("file_path", "file_start").agg(
            F.expr(f"array_join(transform({ordered}, p -> p.record), '\n')").alias("record"),
            F.max("load_order").alias("load_order"),
        )
        whole = whole.unionByName(parts.select(*columns))
    return whole.withColumn("record", F.expr("regexp_replace(record, '\\r$', '')"))
