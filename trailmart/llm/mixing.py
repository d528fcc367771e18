"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of the whole corpus are seats, handed to sources by highest quotients
target / (2 seats + 1), which gives each source an integer quota of words. Documents are
dealt into shards by hash and put into seeded order within each. A round holds, of every
shard, the documents that begin in one block of its words; the stream of a source is its rounds one
after the other, shard by shard within each. A quota is met by whole passes over the stream and
one circular stretch of the remaining words, which begins at a seeded block: every shard gives
the same blocks, but for those of two rounds, so each is a mix by itself as far as it has enough
words of a source. Running totals over rounds and groups of shards place the documents: what a
shard cannot give is not lost but comes from the others, and at most two documents of a source
are in part.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.llm.common import WORD, saved

#: Fixed values of the mix: weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source, and no document, is taken more often than this.
MOST_REPEATS = 3
#: Words of a block, where stretches may begin, and about how many words make a shard.
BLOCK_WORDS = 64
SHARD_WORDS = 500_000
#: Shards whose documents of one round are put in order by one task.
GROUP_SHARDS = 256
SEED = 42


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target of each source from (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of
    all sizes. No target exceeds ``repeats`` times its source; what is cut off is shared
    again by weight. Sources that reach their limit first are those with the smallest
    limit per weight, so one sorted pass over the sources settles the level.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))) + 1)
    weighed = ranked.withColumn("weight", weight.cast("long"))
    most = (F.col("source_size") * repeats).cast("long")
    order = everything.orderBy(F.col("most").cast("double") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighed.withColumn("most", most)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("cut", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("cut_weights", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("cut")).cast("double") / (F.col("all_weights") - F.col("cut_weights")))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("most"))
    )
    # The first source, in that order, whose limit is not reached sets the level for all after it.
    level = F.min(F.when(F.col("free"), F.struct("cut_weights", "level"))).over(everything)["level"]
    return levels.withColumn("final", level).select(
        "source",
        "source_size",
        F.when(F.col("final").isNull(), F.col("most").cast("double"))
        .otherwise(F.least(F.col("most").cast("double"), F.col("final") * F.col("weight")))
        .alias("target"),
    )


def apportion(targets: list[float], limits: list[int], seats: int) -> list[int]:
    """Sainte-Laguë: seats by highest quotients, none beyond its limit; ties to the first.

    Every quotient of at least one seat's price is granted at once, the rest one by one.
    """
    total = sum(targets)
    if total <= 0 or seats <= 0:
        return [0] * len(targets)
    price = total / seats
    # Quotients above a slightly higher price are certainly among the highest.
    quota = [min(limit, max(0, int(t / price + 0.5) - 1 - int(t / total * len(targets)))) for t, limit in zip(targets, limits, strict=True)]
    heap = [(-t / (2 * q + 1), i) for i, (t, q, m) in enumerate(zip(targets, quota, limits, strict=True)) if q < m and t > 0]
    heapq.heapify(heap)
    left = seats - sum(quota)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        quota[i] += 1
        left -= 1
        if quota[i] < limits[i]:
            heapq.heappush(heap, (-targets[i] / (2 * quota[i] + 1), i))
    return quota


QUOTA_SCHEMA = "source string, source_size long, target double, quota long"


def source_quotas(targets: DataFrame, repeats: int) -> DataFrame:
    """Adds the quota of every source in the whole corpus, in words."""

    def seats(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", kind="stable")
        limits = (rows["source_size"] * repeats).tolist()
        quota = apportion(rows["target"].tolist(), limits, round(float(rows["target"].sum())))
        return rows.assign(quota=quota)[["source", "source_size", "target", "quota"]]

    return targets.groupBy().applyInPandas(seats, QUOTA_SCHEMA)


def overlap(low: Column, high: Column, start: Column, end: Column) -> Column:
    return F.greatest(F.least(high, end) - F.greatest(low, start), F.lit(0))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and text hash of every row.

    A null text has size 0, a null source is a source of its own (the last), repeated rows
    count as often as they occur. The same rows give the same result in any order. At
    the ends of a stretch a document may be taken in part. Other columns are not read.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    rows, _ = saved(sized, "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, _ = saved(source_quotas(source_targets(by_source, weights, repeats), repeats), "mix-targets")
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    shards = max(1, round(total / shard_words))
    place = F.xxhash64(F.lit(seed), "doc_id", "tie")
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "tie"), F.lit(shards))
    # Empty texts have nothing to give and no place in a stream.
    dealt = rows.where("size > 0").withColumn("shard", shard)
    inside = Window.partitionBy("shard", "source").orderBy(place, "doc_id", "tie")
    within = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rounds = dealt.withColumn("round", F.floor(within / F.lit(block_words)))
    rounds, _ = saved(rounds.withColumn("group", F.floor(F.col("shard") / F.lit(GROUP_SHARDS))), "mix-rounds")

    # Words of a source before each of its rounds, and of a round before each group of shards.
    parts = rounds.groupBy("source", "round", "group").agg(F.sum("size").alias("words"))
    parts, _ = saved(parts, "mix-parts")
    earlier = Window.partitionBy("source").orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.groupBy("source", "round").agg(F.sum("words").alias("words"))
    begins = begins.select(
        F.col("source").alias("b_source"), F.col("round").alias("b_round"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin")
    )
    ahead = Window.partitionBy("source", "round").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    q = ahead.join(begins, ahead["source"].eqNullSafe(begins["b_source"]) & (ahead["round"] == begins["b_round"]))
    q = q.join(targets.withColumnRenamed("source", "t_source"), q["source"].eqNullSafe(F.col("t_source"))).select(
        F.col("source").alias("q_source"),
        F.col("round").alias("q_round"),
        F.col("group").alias("q_group"),
        (F.col("begin") + F.col("ahead")).alias("begin"),
        *("source_size", "quota"),
    )
    turn = Window.partitionBy("source", "round", "group").orderBy("shard", place, "doc_id", "tie")
    behind = F.sum("size").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rounds.withColumn("behind", behind)
    own = placed["source"].eqNullSafe(q["q_source"]) & (placed["round"] == q["q_round"]) & (placed["group"] == q["q_group"])
    joined = placed.join(q, own).withColumn("start", F.col("begin") + F.col("behind"))
    joined = joined.withColumn("end", F.col("start") + F.col("size"))
    passes = F.floor(F.col("quota") / F.col("source_size"))
    rest = F.col("quota") - passes * F.col("source_size")
    blocks = F.ceil(F.col("source_size") / F.lit(block_words))
    low = F.pmod(F.xxhash64(F.lit(seed + 2), "source"), blocks) * block_words
    high = low + rest
    taken = (
        passes * F.col("size")
        + overlap(low, F.least(high, F.col("source_size")), F.col("start"), F.col("end"))
        + overlap(F.lit(0), high - F.col("source_size"), F.col("start"), F.col("end"))
    )
    mixed = joined.select("doc_id", "source", "size", "tie", taken.cast("long").alias("taken"))
    mixed = mixed.unionByName(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    return mixed.join(t, mixed["source"].eqNullSafe(t["t_source"])).select(
        "doc_id", "size", "source_size", "target", "taken", "tie"
    )


def mixed_documents(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mix as rows: every document as often as the mix takes it, rounded to whole ones.

    Columns are those of ``docs``. Repeated rows of one doc_id and text share their words.
    """
    taken = mix(docs, shard_words=shard_words).groupBy("doc_id", "tie").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("share"))
    times = taken.where("share > 0").select(
        F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.round("share").cast("int").alias("__times")
    )
    same = docs["doc_id"].eqNullSafe(times["__id"]) & F.xxhash64(docs["text"]).eqNullSafe(times["__tie"])
    rows = docs.join(times.where("__times > 0"), same)
    return rows.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), "__times")).alias("__n")).drop("__n")
