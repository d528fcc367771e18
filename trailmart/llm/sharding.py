"""Sharding by extendible hashing: a directory of hash prefixes, split where a shard is too large.

A bucket is addressed by the first bits of the key's hash. It splits on one more bit only
when its rows exceed the byte limit, so depths differ from bucket to bucket. Several bits
are looked at per round: one aggregation gives the bytes of every prefix of those lengths
and each row goes to the shortest prefix that fits; only rows of prefixes that are still
too large take part in the next round. Rows with equal keys cannot be told apart by bits;
if they alone exceed the limit, the bucket gets overflow pages filled in order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import discard, saved

#: Bits taken from the hash of a key: as many as 15 hexadecimal digits have.
HASH_BITS = 60
ROUND_BITS = 10
SHARD_BYTES = 16 << 20


def key_hash(key: Column) -> Column:
    """The leading 60 bits of the MD5 of the key as text; a null key hashes like an empty one."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def prefix(hashed: Column, bits: int) -> Column:
    return F.shiftright(hashed, HASH_BITS - bits) if bits else F.lit(0).cast("long")


def round_directory(rows: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """Per prefix of ``depth`` bits: the shallowest fitting depth above ``base``, or null."""
    cells = rows.groupBy(prefix(F.col("hashed"), depth).alias("cell")).agg(F.sum("bytes").alias("n"))
    levels = [bits for bits in range(0 if base == 0 else base + 1, depth + 1)]
    ancestors = F.array(*(
        F.struct(F.lit(bits).alias("bits"), F.shiftright("cell", depth - bits).alias("own")) for bits in levels
    ))
    above = cells.select("cell", "n", F.explode(ancestors).alias("a")).select("cell", "n", "a.bits", "a.own")
    fits = above.groupBy("bits", "own").agg(F.sum("n").alias("total")).where(F.col("total") <= limit)
    found = above.join(fits, ["bits", "own"]).groupBy("cell").agg(F.min("bits").alias("depth"))
    return cells.join(found, "cell", "left").select("cell", "depth")


def assign_shards(
    docs: DataFrame,
    key: str = "doc_id",
    size: Column | None = None,
    limit: int = SHARD_BYTES,
    row: Column | None = None,
) -> DataFrame:
    """Key, bytes, depth, shard (depth, prefix bits and page) and row number of every row.

    ``size`` defaults to the UTF-8 bytes of ``text``; null counts as 0. A single row larger
    than ``limit`` gets a page to itself and any other page fits the limit. An empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    size = F.octet_length("text") if size is None else size
    row = F.monotonically_increasing_id() if row is None else row
    hashed = docs.select(
        F.col(key),
        F.coalesce(size.cast("long"), F.lit(0)).alias("bytes"),
        key_hash(F.col(key)).alias("hashed"),
        row.alias("row"),
    )
    rows, _ = saved(hashed, "shard-rows")
    done, base, left = None, 0, rows
    while True:
        depth = min(HASH_BITS, base + ROUND_BITS)
        directory, _ = saved(round_directory(left, base, depth, limit), "shard-directory")
        looked = left.withColumn("cell", prefix(F.col("hashed"), depth)).join(directory, "cell").drop("cell")
        fixed = looked.where(F.col("depth").isNotNull()).withColumn("page", F.lit(0).cast("long"))
        done = fixed if done is None else done.unionByName(fixed)
        if directory.where("depth is null").isEmpty():
            break
        left, _ = saved(looked.where("depth is null").drop("depth"), "shard-left")
        if depth == HASH_BITS:
            done = done.unionByName(overflow(left, limit))
            break
        base = depth
    bits = F.lpad(F.bin("hashed"), HASH_BITS, "0")
    name = F.concat(F.col("depth").cast("string"), F.lit("-"), F.substring(bits, F.lit(1), F.col("depth")),
                    F.lit("-"), F.col("page").cast("string"))
    return done.select(key, "bytes", F.col("depth").cast("int").alias("depth"), name.alias("shard"), "row")


def overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows of equal hash: half-limit strides of the running bytes, by arrival.

    Running totals are taken within slices of consecutive rows and then shifted by the
    totals of the slices before, so that a hot key is never sorted as a whole.
    """
    from pyspark.sql import Window

    sliced = rows.withColumn("slice", F.floor(F.col("row") / F.lit(1 << 16)))
    inner = Window.partitionBy("hashed", "slice").orderBy("row")
    totals = sliced.groupBy("hashed", "slice").agg(F.sum("bytes").alias("total"))
    before = Window.partitionBy("hashed").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("hashed", "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    placed = sliced.join(offsets, ["hashed", "slice"]).withColumn(
        "start", F.col("offset") + F.sum("bytes").over(inner) - F.col("bytes")
    )
    # Rows of at most half the limit that start in one stride of half the limit fit a page together.
    half = F.lit(max(1, limit // 2))
    stride = F.floor(F.col("start") / half)
    alone = F.col("bytes") * 2 > limit
    page = F.when(alone, F.lit(1 << 40) + F.col("row")).otherwise(stride)
    return placed.select(
        *(c for c in rows.columns), F.lit(HASH_BITS).alias("depth"), page.cast("long").alias("page")
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", limit: int = SHARD_BYTES) -> DataFrame:
    """Write ``docs`` into one folder per shard below ``path``; returns the assignment.

    Rows are numbered in a stored copy first, so that rows of equal keys keep their page.
    """
    numbered, numbered_path = saved(docs.withColumn("__row", F.monotonically_increasing_id()), "shard-input")
    assigned, _ = saved(assign_shards(numbered, key, limit=limit, row=F.col("__row")), "shard-assignment")
    joined = numbered.join(assigned.select(F.col("row").alias("__row"), "shard"), "__row").drop("__row")
    joined.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    discard(docs.sparkSession, numbered_path)
    return assigned
