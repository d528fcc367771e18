"""Mixing where a source has about one short document in each shard."""

from __future__ import annotations

from collections import Counter

import pytest

from trailmart.llm import mixing
from trailmart.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("short", [8, 15, 40, 100])
def test_small_source_over_many_shards(spark, short):
    prepare(spark)
    rows = [(i, "word " * 120, "en", "big" if i % 3 else "medium", 0) for i in range(600)]
    rows += [(n + i, "few " * short, "en", source, 0) for i in range(50) for n, source in ((1000, "small"), (2000, None))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    shard_words = sum(len(text.split()) for _, text, *_ in rows) // 50
    mixed = mixing.mix(docs, shard_words=shard_words).collect()
    taken, goals = Counter(), {}
    sizes = spark.createDataFrame(rows, SCHEMA).groupBy("source").agg(
        mixing.F.sum(mixing.word_count(mixing.F.col("text"))).alias("source_size")
    )
    for r in mixing.source_targets(sizes).collect():
        goals[r.source] = r.target
    assert sum(r.taken for r in mixed) == pytest.approx(sum(goals.values()), abs=1)
    for r in mixed:
        assert r.taken <= 3 * r.size
        taken[r.source_size, r.target] += r.taken
    expected = Counter()
    for source, goal in goals.items():
        expected[sum(len(t.split()) for _, t, _, s, _ in rows if s == source), goal] += goal
    assert set(taken) == set(expected)
    assert all(abs(got - expected[key]) <= 2 for key, got in taken.items())

    # Whole documents: no source is off by more than its longest ones at both ends.
    words = Counter()
    for r in mixing.mixed_documents(docs, shard_words).collect():
        words[r.source] += len(r.text.split())
    assert all(abs(words[s] - goal) <= (120 if s in ("big", "medium") else short) + 2 for s, goal in goals.items())


def test_every_shard_gives_its_part(spark):
    """A source of which a part is taken gives words from every shard, and from none all of them."""
    prepare(spark)
    rows = [(i, "word " * 20, "en", "abc"[i % 3], 0) for i in range(1800)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    shards = 12
    own = mixing.F.pmod(mixing.F.xxhash64(mixing.F.lit(mixing.SEED + 1), "doc_id", "tie"), mixing.F.lit(shards))
    taken, present = Counter(), Counter()
    for r in mixing.mix(docs, shard_words=len(rows) * 20 // shards).withColumn("shard", own).collect():
        source = "abc"[r.doc_id % 3]
        taken[source, r.shard] += r.taken
        present[source, r.shard] += r.size
    assert len(present) == 3 * shards
    for source, share in (("a", 15 / 8), ("b", 6 / 8), ("c", 3 / 8)):
        for shard in range(shards):
            assert abs(taken[source, shard] / present[source, shard] - share) < 0.25
        whole = sum(taken[source, shard] for shard in range(shards))
        assert whole == pytest.approx(share * 600 * 20, abs=2)
