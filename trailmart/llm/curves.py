"""Approximate nearest neighbours by inner product along shifted Hilbert curves.

Vectors are lifted by one coordinate, so that the largest inner product is the nearest
point, and projected to a few dimensions, once per curve with another projection and grid
shift. Each curve orders all vectors by their Hilbert key; Spark range-partitions and ranks
them and cuts the order into blocks of bounded size. A block of queries meets the blocks
within a window around it, exact inner products rank what meets, and the best of all
curves merge. The window is a share of the table: vectors without any structure have no
neighbours in key order otherwise, and the recall would fall as the table grows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmart.llm.common import discard, saved

CURVES = 10
DIMENSIONS = 8
BITS = 6
#: Part of the table searched on either side of a query, per curve.
WINDOW_SHARE = 0.1
#: Vectors of one block: what a task holds of a curve at a time.
BLOCK_ROWS = 8192
NEIGHBOURS = 20
QUERY_STEP = 20
SEED = 42
#: Standard deviations from the centre to the edge of the grid.
SPAN = 4.0


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid coordinates.

    Coordinates become Gray-coded axes by undoing, from the highest bit down, the
    reflection and exchange of axes in each quadrant; the bits are then interleaved.
    """
    axes = [column.astype(np.uint64) for column in np.ascontiguousarray(cells.T)]
    for bit in range(bits - 1, 0, -1):
        below = np.uint64((1 << bit) - 1)
        for k, axis in enumerate(axes):
            on = (axis >> np.uint64(bit)) & np.uint64(1) == 1
            swap = np.where(on, np.uint64(0), (axes[0] ^ axis) & below)
            axes[0] = np.where(on, axes[0] ^ below, axes[0] ^ swap)
            axes[k] = axes[k] ^ swap if k else axes[0]
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    flip = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint64(bit)) & np.uint64(1) == 1, np.uint64((1 << bit) - 1), np.uint64(0))
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << np.uint64(1) | ((axis ^ flip) >> np.uint64(bit)) & np.uint64(1)
    return key.astype(np.int64)


class Curves:
    """Projections and shifts of all curves, the same wherever they are made."""

    def __init__(self, width: int, count: int, dimensions: int, seed: int):
        rng = np.random.default_rng(seed)
        directions = rng.standard_normal((width + 1, count * dimensions))
        self.directions = directions / np.linalg.norm(directions, axis=0)
        self.shifts = rng.uniform(-0.5, 0.5, count * dimensions) * 2 * SPAN / (1 << BITS)
        self.count, self.dimensions = count, dimensions

    def coordinates(self, vectors: np.ndarray, longest: float, as_query: bool) -> np.ndarray:
        """Projections of the lifted vectors; queries are scaled to the longest vector."""
        norms = np.linalg.norm(vectors, axis=1)
        if as_query:
            scaled = vectors / norms[:, None] * longest
            lift = np.zeros(len(vectors))
        else:
            scaled, lift = vectors, np.sqrt(np.maximum(longest**2 - norms**2, 0))
        return np.column_stack([scaled, lift]) @ self.directions

    def keys(self, coordinates: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
        """One Hilbert key per row and curve."""
        standard = (coordinates - mean) / deviation + self.shifts
        cells = np.clip((standard / (2 * SPAN) + 0.5) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        parts = np.split(cells, self.count, axis=1)
        return np.column_stack([hilbert_keys(part, BITS) for part in parts])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def distinct_points(vectors: DataFrame, step: int, keep: int) -> tuple[DataFrame, DataFrame]:
    """Usable vectors (id, vec), and the distinct ones with their ``keep`` smallest ids.

    A result of k rows never needs more than the k + 1 smallest ids of equal vectors.
    """
    whole = F.filter(F.col("embedding").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    clean = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")).where(
        (F.size("embedding") > 0) & (F.size(whole) == F.size("embedding")) & F.exists("vec", lambda x: x != 0)
    )
    clean = clean.where("id is not null")
    width = clean.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    usable, _ = saved(clean.where(F.size("vec") == (width["n"] if width else 0)), "ann-vectors")
    classes = usable.groupBy("vec").agg(F.min("id").alias("cls"), F.bool_or(F.col("id") % step == 0).alias("asked"))
    number = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    first = usable.distinct().withColumn("n", number).where(F.col("n") <= keep)
    ids = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points, _ = saved(classes.join(ids, "vec"), "ann-points")
    return usable, points


def moments(points: DataFrame, curves: Curves, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every projected coordinate over all points."""

    def sums(batches):
        for batch in batches:
            x = curves.coordinates(matrix(batch.column("vec")), longest, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(x.shape[1])), pa.array(np.full(x.shape[1], float(len(x)))), pa.array(x.sum(0)), pa.array((x**2).sum(0))],
                ["k", "n", "s", "q"],
            )

    totals = points.select("vec").mapInArrow(sums, "k long, n double, s double, q double")
    # As many rows as there are projected coordinates, whatever the table.
    rows = totals.groupBy("k").agg(*(F.sum(c).alias(c) for c in "nsq")).orderBy("k").collect()
    n, s, q = (np.array([r[c] for r in rows]) for c in "nsq")
    return s / n, np.sqrt(np.maximum(q / n - (s / n) ** 2, 1e-24))


def entries(points: DataFrame, curves: Curves, longest: float, mean, deviation) -> DataFrame:
    """curve, key, cls, asking, vec: every point, and every query point, on every curve."""

    def emit(batches):
        for batch in batches:
            x, cls = matrix(batch.column("vec")), batch.column("cls").to_numpy()
            asked = np.flatnonzero(batch.column("asked").to_numpy(zero_copy_only=False).astype(bool))
            for chosen, asking in ((np.arange(len(x)), False), (asked, True)):
                keys = curves.keys(curves.coordinates(x[chosen], longest, asking), mean, deviation)
                for curve in range(curves.count):
                    arrays = [
                        pa.array(np.full(len(chosen), curve, np.int32)), pa.array(keys[:, curve]), pa.array(cls[chosen]),
                        pa.array(np.full(len(chosen), asking)), batch.column("vec").take(pa.array(chosen)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["curve", "key", "cls", "asking", "vec"])

    return points.select("cls", "asked", "vec").mapInArrow(
        emit, "curve int, key long, cls long, asking boolean, vec array<double>"
    )


def in_blocks(rows: DataFrame, total: int, block_rows: int) -> DataFrame:
    """Adds ``block``: rows of each curve in key order, cut after every ``block_rows``."""
    parts = max(1, -(-total // block_rows))
    order = ["curve", "key", "cls", "asking"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    placed, path = saved(placed, "ann-order")
    heads = placed.groupBy("curve", "part").agg(F.min("at").alias("head"), F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.select("curve", "part", "head", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.col("at") - F.col("head")
    return placed.join(offsets, ["curve", "part"]).withColumn("block", F.floor(rank / block_rows).cast("int"))


PACKED = "curve int, block int, asking boolean, ids array<long>, vectors binary"


def packed(blocks: DataFrame) -> DataFrame:
    """Candidates and queries of each block as one row each; at most a block of rows."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        made = []
        for asking, own in rows.groupby("asking"):
            own = own.sort_values("cls")
            data = np.stack(own["vec"].to_numpy()).astype(np.float64).tobytes()
            made.append((own["curve"].iloc[0], own["block"].iloc[0], bool(asking), own["cls"].to_numpy(), data))
        return pd.DataFrame(made, columns=["curve", "block", "asking", "ids", "vectors"])

    return blocks.select("curve", "block", "asking", "cls", "vec").groupBy("curve", "block").applyInPandas(pack, PACKED)


def best_of(scores: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``keep`` highest scores of each row, ties to the smaller id."""
    if scores.shape[1] > keep:
        floor = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
        row, column = np.nonzero(scores >= floor[:, None])
    else:
        row, column = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    return row[place < keep], column[place < keep]


def meet(pairs: DataFrame, keep: int) -> DataFrame:
    """asked, found, score: the best candidates of a block for each query of another."""

    def score(batches):
        for batch in batches:
            for r in batch.to_pylist():
                asked, ids = np.array(r["q_ids"]), np.array(r["ids"])
                queries = np.frombuffer(r["q_vectors"]).reshape(len(asked), -1)
                vectors = np.frombuffer(r["vectors"]).reshape(len(ids), -1)
                for low in range(0, len(asked), 512):
                    scores = queries[low : low + 512] @ vectors.T
                    row, column = best_of(scores, ids, keep)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked[low + row]), pa.array(ids[column]), pa.array(scores[row, column])],
                        ["asked", "found", "score"],
                    )

    return pairs.mapInArrow(score, "asked long, found long, score double")


def nearest(
    vectors: DataFrame,
    neighbours: int = NEIGHBOURS,
    step: int = QUERY_STEP,
    share: float = WINDOW_SHARE,
    count: int = CURVES,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score: nearest rows of every row with vec_id divisible by ``step``.

    ``vectors`` has vec_id and embedding. Null or zero vectors, null ids, vectors with null
    or non-finite components and vectors of another length than most take no part. Ties go
    to the smaller vec_id; repeated rows are one candidate. Other columns are not read.
    """
    spark = vectors.sparkSession
    keep = neighbours + 1
    usable, points = distinct_points(vectors, step, keep)
    squares = F.aggregate("vec", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    size = points.agg(F.count("*").alias("n"), F.max(F.sqrt(squares)).alias("longest"), F.max(F.size("vec")).alias("w"),
                      F.count_if("asked").alias("asked")).first()
    if not size["asked"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    curves = Curves(size["w"], count, DIMENSIONS, seed)
    mean, deviation = moments(points, curves, size["longest"])
    per_curve = size["n"] + size["asked"]
    on_curves = entries(points, curves, size["longest"], mean, deviation)
    blocks, _ = saved(packed(in_blocks(on_curves, per_curve * count, block_rows)), "ann-blocks")
    reach = math.ceil(share * per_curve / block_rows)
    asking = blocks.where("asking").select(
        "curve", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("block"),
    )
    pairs = blocks.where("not asking").join(asking, ["curve", "block"]).select("ids", "vectors", "q_ids", "q_vectors")
    met, _ = saved(meet(pairs, keep), "ann-met")

    found = met.groupBy("asked", "found").agg(F.max("score").alias("score"))
    by_class = Window.partitionBy("asked").orderBy(F.desc("score"), "found")
    classes = found.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= keep).drop("n")
    ids = points.select(F.col("cls").alias("found"), F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    each = classes.join(ids, "found").withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= keep)
    each, _ = saved(each.select("asked", "vec_id", "score"), "ann-classes")

    queries = usable.where(F.col("id") % step == 0).select(F.col("id").alias("query_id"), "vec").distinct()
    queries = queries.join(points.select("vec", F.col("cls").alias("asked")), "vec").select("query_id", "asked")
    answered = queries.join(each, "asked").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answered.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= neighbours)
