"""Exact deduplication behind static binary-fuse filters.

An immutable snapshot keeps one row per digest, dealt into buckets of bounded size, and one
binary-fuse filter per bucket. Digests of an incoming batch are grouped among themselves,
screened by the filter of their bucket, and only positives are joined with the exact
bucket, where texts are compared byte for byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import ascii_lower, discard, one_row_each, saved

#: Digests of one snapshot bucket: what one task holds to build a filter.
BUCKET_ROWS = 20_000
#: Bits of the map of ids whose texts are compared.
MAP_BITS = 1 << 23
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def spread(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well mixed 64-bit values of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def layout(count: int) -> tuple[int, int]:
    """Length of a segment and number of start segments for so many keys."""
    length = 1 << max(2, min(14, int(np.log(max(count, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(count, 3)))
    segments = max(1, int(np.ceil(count * factor / length)) - 2)
    return length, segments


def cells(hashes: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three cells of each key in neighbouring segments, one row per key."""
    start = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = start.astype(np.int64) * length
    within = np.stack([hashes, hashes >> np.uint64(18), hashes >> np.uint64(36)], axis=1)
    offset = (within & np.uint64(length - 1)).astype(np.int64)
    return base[:, None] + np.arange(3) * length + offset


def marks(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


@dataclass(frozen=True)
class Filter:
    seed: int
    length: int
    segments: int
    slots: bytes

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """True for every key put in, and for about one in 65,536 others."""
        hashes = spread(keys, self.seed)
        slots = np.frombuffer(self.slots, np.uint16)
        at = cells(hashes, self.length, self.segments)
        return (slots[at[:, 0]] ^ slots[at[:, 1]] ^ slots[at[:, 2]]) == marks(hashes)


def build_filter(keys: np.ndarray) -> Filter:
    """Peel keys that are alone in a cell, round by round, and fill the slots backwards."""
    keys = np.unique(keys)
    length, segments = layout(len(keys))
    for seed in range(1, 1000):
        if seed % 20 == 0:
            segments += 1 + segments // 16
        hashes = spread(keys, seed)
        at = cells(hashes, length, segments)
        size = (segments + 2) * length
        count = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        np.bitwise_xor.at(owner, at.ravel(), np.repeat(np.arange(len(keys)), 3))
        rounds, left = [], len(keys)
        alone = np.flatnonzero(count == 1)
        while len(alone):
            peeled, first = np.unique(owner[alone], return_index=True)
            rounds.append((peeled, alone[first]))
            left -= len(peeled)
            touched = at[peeled].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.repeat(peeled, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            continue
        slots = np.zeros(size, np.uint16)
        mark = marks(hashes)
        for peeled, cell in reversed(rounds):
            slots[cell] = 0
            others = slots[at[peeled]]
            slots[cell] = mark[peeled] ^ others[:, 0] ^ others[:, 1] ^ others[:, 2]
        return Filter(seed, length, segments, slots.tobytes())
    raise RuntimeError("no seed peels all keys")


FILTER_SCHEMA = "bucket long, seed int, length int, segments int, slots binary"


def filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot (bucket, key)."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = build_filter(rows["key"].to_numpy().astype(np.int64).view(np.uint64))
        values = [[int(rows["bucket"].iloc[0]), made.seed, made.length, made.segments, made.slots]]
        return pd.DataFrame(values, columns=["bucket", "seed", "length", "segments", "slots"])

    return snapshot.groupBy("bucket").applyInPandas(build, FILTER_SCHEMA)


def screened(incoming: DataFrame, filter_table: DataFrame) -> DataFrame:
    """Rows of ``incoming`` (bucket, key, digest) that the filter of their bucket lets pass.

    Buckets without a filter hold nothing, so their rows cannot be duplicates.
    """
    schema = incoming.schema

    def probe(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or own.empty:
            return rows.iloc[:0]
        f = own.iloc[0]
        check = Filter(int(f["seed"]), int(f["length"]), int(f["segments"]), bytes(f["slots"]))
        return rows[check.holds(rows["key"].to_numpy().astype(np.int64).view(np.uint64))]

    return incoming.groupBy("bucket").cogroup(filter_table.groupBy("bucket")).applyInPandas(probe, schema)


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: largest doc_id, the row that holds it, number of rows."""
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    return rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.max_by("row", order).alias("keeper"), F.count("*").alias("rows")
    )


def bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return groups.select("*", key.alias("key"), F.pmod(F.xxhash64(key, F.lit(7)), F.lit(buckets)).alias("bucket"))


def map_of(keys: DataFrame) -> DataFrame:
    """One row: the marked places of 64-bit ``key`` values as an array of words, of 1 MB for any number of keys."""
    place = F.pmod("key", F.lit(MAP_BITS)).alias("place")
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = keys.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(MAP_BITS // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    ordered = "array_sort(collect_list(struct(word, coalesce(bits, 0L) as bits)))"
    return every.agg(F.expr(f"transform({ordered}, x -> x.bits)").alias("words"))


def is_marked(key: Column, words: Column) -> Column:
    """Whether the map has the place of ``key``: always if it was put in, else seldom while keys are few."""
    place = F.pmod(key, F.lit(MAP_BITS))
    word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
    return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def exact_dedup(docs: DataFrame, is_new=None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of a group
    the row with the largest doc_id stays (null is smallest); of several rows with that id
    one stays. ``is_new`` says which rows came after the snapshot was taken; by default
    half of the rows, dealt by hash. Other columns of ``docs`` are not read.

    Rows of the snapshot, and of the batch, are grouped by SHA-256 among themselves. A group
    of the batch joins one of the snapshot only through filter, exact bucket and a comparison of
    the bytes of one text of each; groups screened out stay by themselves. For the
    comparison only rows move whose id a map of fixed size marks.
    """
    spark = docs.sparkSession
    is_new = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1 if is_new is None else is_new
    text = ascii_lower(F.coalesce("text", F.lit("")))
    own_id = F.col("doc_id").cast("long")
    base = docs.select(own_id.alias("doc_id"), F.sha2(text, 256).alias("digest"), is_new.alias("is_new"))
    rows, _ = saved(base.withColumn("row", F.monotonically_increasing_id()), "dedup-digests")
    buckets = max(1, -(-rows.count() // bucket_rows))

    snapshot, snapshot_path = saved(bucketed(grouped(rows.where(~F.col("is_new"))), buckets), "dedup-snapshot")
    filter_table, filter_path = saved(filters(snapshot.select("bucket", "key")), "dedup-filters")
    batch, batch_path = saved(bucketed(grouped(rows.where("is_new")), buckets), "dedup-batch")

    # Positives against the exact bucket: equal digests first, then the texts themselves.
    hits = screened(batch.select("bucket", "key", "digest"), filter_table).select("bucket", "digest")
    older = snapshot.select("bucket", "digest", F.col("keep_id").alias("old_id"))
    newer = batch.select("bucket", "digest", F.col("keep_id").alias("new_id"))
    same_key = ["bucket", "digest"]
    pairs, pairs_path = saved(hits.join(older, same_key).join(newer, same_key), "dedup-hits")
    sides = pairs.select("digest", F.explode(F.array("new_id", "old_id")).alias("id"))
    wanted, wanted_path = saved(map_of(sides.select(F.xxhash64("id").alias("key"))), "dedup-wanted")
    moving = docs.select(own_id.alias("doc_id"), "text").where(is_marked(F.xxhash64("doc_id"), wanted.scalar()))
    texts = moving.select(F.col("doc_id").alias("id"), text.alias("bytes"), F.sha2(text, 256).alias("sum"))
    same = (texts["id"].eqNullSafe(sides["id"])) & (texts["sum"] == sides["digest"])
    # The same join at every size: texts are not to be dealt out only once sides are many.
    compared = texts.join(sides.hint("merge"), same).groupBy("digest")
    compared = compared.agg((F.min("bytes") == F.max("bytes")).alias("equal"))
    clash = F.assert_true("equal", F.lit("two texts share a SHA-256 digest"))
    verified, verified_path = saved(compared.where(clash.isNull()).select("digest"), "dedup-verified")

    joining = batch.join(verified, "digest").select(
        "digest", F.struct("keep_id", "keeper", "rows").alias("new")
    )
    is_larger = F.coalesce(F.col("new.keep_id") > F.col("keep_id"), F.col("keep_id").isNull() & F.col("new").isNotNull())
    extended = snapshot.join(joining, "digest", "left").select(
        "digest",
        F.when(is_larger, F.col("new.keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(is_larger, F.col("new.keeper")).otherwise(F.col("keeper")).alias("keeper"),
        (F.col("rows") + F.coalesce("new.rows", F.lit(0))).alias("rows"),
    )
    alone = batch.join(verified, "digest", "left_anti").select("digest", "keep_id", "keeper", "rows")
    groups, _ = saved(extended.unionByName(alone), "dedup-groups")
    discard(spark, snapshot_path, filter_path, batch_path, pairs_path, wanted_path, verified_path)
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        F.col("rows").alias("group_size"),
        (F.col("row") == F.col("keeper")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, with all their columns."""
    kept = exact_dedup(docs).where("kept").select("doc_id", F.col("text_sha256").alias("tie"))
    return one_row_each(docs, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256).alias("tie"), kept)
