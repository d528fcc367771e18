"""SimHash near-duplicates through a segment-popcount grid.

A 64-bit fingerprint is cut into 32 segments of two bits; the popcounts of the segments,
packed into two-bit fields, are its embedding. Changing one bit moves one count by at most
one, so the Manhattan distance of embeddings is a lower bound of the Hamming distance. Of
three blocks of segments, two fingerprints at most 4 bits apart differ by at most 1 in
one block: there they share a unit cell of the grid or lie in cells that are neighbours.
Each fingerprint is put into its cell and into the cells one step up, so that every such
pair meets in a cell; fingerprints that meet are compared exactly.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.llm.common import discard, one_row_each, saved
from trailmart.llm.components import components

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
#: Segments of each block of the grid.
BLOCKS = (11, 11, 10)
#: Rows of one cell that meet in one group; larger cells are compared block against block.
CELL_ROWS = 4096
CHUNK_SHINGLES = 1 << 16
ODD_BITS = 0x5555555555555555
#: Stands for a null doc_id, which counts only where a component has no other.
LAST_ID = (1 << 63) - 1


def fingerprints_of(texts: list[str | None]) -> np.ndarray:
    """SimHash of the word shingles of each text as unsigned 64-bit numbers."""
    from xxhash import xxh64_intdigest

    space = re.compile(rb"[^\x20\x09-\x0d]+")
    result = np.zeros(len(texts), np.uint64)
    hashes, owners, sizes, waiting = [], [], [], 0

    def flush():
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum([0, *sizes[:-1]])
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        np.add.at(totals, owners, counts)

    totals = np.zeros((len(texts), 64), np.int64)
    number = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = space.findall((text or "").encode().lower())
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= SHINGLE_WORDS:
            shingles = [xxh64_intdigest(joined, HASH_SEED)]
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:-SHINGLE_WORDS]]).tolist()
            shingles = [
                xxh64_intdigest(joined[a:b], HASH_SEED)
                for a, b in zip(starts, (ends[SHINGLE_WORDS - 1 :] - 1).tolist(), strict=True)
            ]
        number[k] = len(shingles)
        for low in range(0, len(shingles), CHUNK_SHINGLES):
            part = shingles[low : low + CHUNK_SHINGLES]
            hashes.extend(part)
            owners.append(k)
            sizes.append(len(part))
            waiting += len(part)
            if waiting >= CHUNK_SHINGLES:
                flush()
                hashes.clear(), owners.clear(), sizes.clear()
                waiting = 0
    if waiting:
        flush()
    result |= np.packbits(totals * 2 > number[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return result


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Signed view of the fingerprint; 0 for a null text or one without words."""
    return pa.array(fingerprints_of(texts.to_pylist()).view(np.int64))


def split_counts(value: Column) -> list[Column]:
    """One number per block of the grid from the counts of both bit positions."""
    low = value.bitwiseAND(F.lit(ODD_BITS))
    high = F.shiftrightunsigned(value, 1).bitwiseAND(F.lit(ODD_BITS))
    blocks, at = [], 0
    for size in BLOCKS:
        mask = F.lit((1 << 2 * size) - 1)
        blocks.append(F.shiftrightunsigned(low, at).bitwiseAND(mask) + F.shiftrightunsigned(high, at).bitwiseAND(mask))
        at += 2 * size
    return blocks


def grid(prints: DataFrame) -> DataFrame:
    """cell, fp, home: each fingerprint at home in one cell per block and guest one step up."""
    cells = []
    for block, (size, counts) in enumerate(zip(BLOCKS, split_counts(F.col("fp")), strict=True)):
        named = counts + F.lit(block << 32)
        cells.append(F.struct(named.alias("cell"), F.lit(True).alias("home")))
        cells += [
            F.struct((named + F.lit(1 << 2 * k)).alias("cell"), F.lit(False).alias("home")) for k in range(size)
        ]
    return prints.select("fp", F.explode(F.array(*cells)).alias("at")).select("at.cell", "fp", "at.home")


def blocked(rows: DataFrame, limit: int) -> DataFrame:
    """Adds ``pair``: cells above ``limit`` rows are cut into blocks that meet pairwise."""
    crowded = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(5)), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("parts") - 1).cast("long")))
    joined = rows.join(crowded.select("cell", parts.alias("parts")), "cell", "left")
    joined = joined.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", own)
    joined = joined.withColumn("other", other)
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    return joined.select("cell", pair.alias("pair"), "fp", "home")


def spanning_links(values: np.ndarray, home: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected through pairs with a member at home.

    Breadth first: a value is compared only with those its component has not reached, so
    a dense group costs little more than its size, and gives one link per member.
    """
    links = []
    seen = np.zeros(len(values), bool)
    for start in np.flatnonzero(home):
        if seen[start]:
            continue
        seen[start] = True
        frontier = np.array([start])
        while len(frontier):
            found = []
            for low in range(0, len(frontier), 256):
                part = frontier[low : low + 256]
                for group, open_to in ((part[home[part]], ~seen), (part[~home[part]], ~seen & home)):
                    targets = np.flatnonzero(open_to & ~seen)
                    if not len(group) or not len(targets):
                        continue
                    near = np.bitwise_count(values[group][:, None] ^ values[targets][None, :]) <= bits
                    reached = targets[near.any(axis=0)]
                    seen[reached] = True
                    found.append(reached)
            frontier = np.concatenate(found) if found else np.zeros(0, np.int64)
            links += [(int(start), int(x)) for x in frontier]
    return links


def links_in_cells(rows: DataFrame, bits: int) -> DataFrame:
    """u, v: enough links between fingerprints that meet in a cell and differ in few bits."""

    def compare(batches):
        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = frame[["cell", "pair"]].to_numpy()
            if not len(keys):
                continue
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            # The last group may go on in the next batch.
            rest = frame.iloc[cut:]
            if cut:
                yield linked(frame.iloc[:cut])
        if rest is not None and len(rest):
            yield linked(rest)

    def linked(frame):
        keys = frame[["cell", "pair"]].to_numpy()
        values = frame["fp"].to_numpy().view(np.uint64)
        home = frame["home"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        ends = np.append(starts[1:], len(keys))
        at_home = np.add.reduceat(home.astype(np.int64), starts)
        pairs = []
        for low, high in zip(starts[(at_home > 0) & (ends - starts > 1)], ends[(at_home > 0) & (ends - starts > 1)], strict=True):
            pairs += [(low + a, low + b) for a, b in spanning_links(values[low:high], home[low:high], bits)]
        index = np.array(pairs, np.int64).reshape(-1, 2)
        signed = values.view(np.int64)
        return pd.DataFrame({"u": signed[index[:, 0]], "v": signed[index[:, 1]]})

    sorted_rows = rows.repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    return sorted_rows.mapInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, text hash, fp, component_id, chosen of every row; fingerprints link at ``bits`` or fewer bits.

    ``component_id`` is the smallest doc_id reachable; null ids count only where a component
    has no other, and ``chosen`` marks the row (or equal rows) it stands for. Texts without words, and null texts, have fingerprint zero. Repeated
    rows repeat in the result. Other columns are not read.
    """
    spark = docs.sparkSession
    if bits > MAX_BITS:
        raise ValueError("the three blocks of the grid serve distances up to 4")
    marks = docs.select("doc_id", F.xxhash64("text").alias("tie"), fingerprint(F.col("text")).alias("fp"))
    marked, _ = saved(marks, "simhash-prints")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "tie")).alias("first")
    classes, classes_path = saved(marked.groupBy("fp").agg(first), "simhash-classes")
    cells, cells_path = saved(grid(classes.select("fp")), "simhash-cells")
    links, links_path = saved(links_in_cells(blocked(cells, cell_rows), bits).distinct(), "simhash-links")
    roots = components(links).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("chosen"))
    members, _ = saved(rooted.select("fp", "root").join(smallest, "root").select("fp", "chosen"), "simhash-members")
    discard(spark, cells_path, classes_path, links_path)
    own_id = F.coalesce("doc_id", F.lit(LAST_ID))
    return marked.join(members, "fp").select(
        "doc_id",
        "tie",
        "fp",
        F.nullif("chosen.id", F.lit(LAST_ID)).alias("component_id"),
        ((own_id == F.col("chosen.id")) & (F.col("tie") == F.col("chosen.tie"))).alias("chosen"),
    )


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, all columns: that of the smallest doc_id."""
    chosen = near_duplicates(docs).where("chosen").select("doc_id", "tie").distinct()
    return one_row_each(docs, F.xxhash64("text").alias("tie"), chosen)
