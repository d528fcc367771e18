"""Substring deduplication by recompression.

Every word has a name, the same wherever it occurs. A run round names isolated double
words; a pair round names neighbouring symbols whose hash bits say left and right. A name
is a hash of the names it stands for, so all Spark tasks give equal material equal names
without a common dictionary, and whether two symbols merge depends on them (a run: on its
neighbours) alone. Equal stretches of text therefore have equal symbols inside; at each end
at most 2 + 2 words may be named otherwise, and no symbol is longer than 4 words. Three
more rounds name every pair of neighbours, pair of pairs and so on: 2, 4 and 8 symbols.

A window of 35 words so has 27 words in its middle that are named alike wherever the window
occurs, and at least five whole symbols there. The least name of eight symbols in the middle
(of four, where there are not eight) is the anchor of the window: equal windows have equal
anchors, and neighbouring windows mostly share theirs. Anchors that occur once rule their windows out. The
windows of the others are verified by 128-bit names over all their words. A hash collision
of anchors only costs time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.llm.common import Codes, discard, saved

#: Fixed by the proof above: a window of this many words, of which the middle is named alike.
WINDOW = 35
EDGE = 4
#: Words worked on at a time, and distinct words remembered.
CHUNK_WORDS = 400_000
CACHE_WORDS = 300_000
U = np.uint64


def mix(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit name for the ordered pair of two names."""
    with np.errstate(over="ignore"):
        x = a * U(0x9E3779B97F4A7C15) ^ (b + U((0x632BE59BD9B4E019 + salt * 0x2545F4914F6CDD1D) & (2**64 - 1)))
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class WordNames:
    """Two independent 64-bit names of each word, from one 128-bit hash."""

    def __init__(self):
        self.codes, self.lanes = Codes(), np.zeros((1 << 12, 2), U)

    def of(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_128_digest

        codes = self.codes
        if len(codes) > CACHE_WORDS:
            codes.clear()
        known = len(codes)
        index = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        if codes.fresh:
            if len(codes) > len(self.lanes):
                grown = np.zeros((max(len(codes), 2 * len(self.lanes)), 2), U)
                grown[:known] = self.lanes[:known]
                self.lanes = grown
            raw = np.frombuffer(b"".join(map(xxh3_128_digest, codes.fresh)), ">u8")
            self.lanes[known : len(codes)] = raw.reshape(-1, 2)
            codes.fresh.clear()
        return self.lanes[index]


def merge(names, lengths, owner, at, new_names):
    """Replace the symbols at ``at`` and after them by one each."""
    names[at] = new_names
    lengths[at] += lengths[at + 1]
    stay = np.ones(len(names), bool)
    stay[at + 1] = False
    return names[stay], lengths[stay], owner[stay]


def recompress(names: np.ndarray, owner: np.ndarray):
    """Names, lengths in words and owners of the symbols after the run and the pair round."""
    lengths = np.ones(len(names), np.int64)
    same = np.zeros(len(names) + 1, bool)
    same[1:-1] = (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])
    at = np.flatnonzero(same[1:-1] & ~same[:-2] & ~same[2:]) if len(names) > 1 else np.zeros(0, np.int64)
    names, lengths, owner = merge(names.copy(), lengths, owner, at, mix(names[at], names[at], 1))
    right = (mix(names, names, 2) >> U(63)).astype(bool)
    at = np.flatnonzero(~right[:-1] & right[1:] & (owner[:-1] == owner[1:]))
    return merge(names, lengths, owner, at, mix(names[at], names[at + 1], 3))


def least_in_ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low..high]`` (both included) by doubling."""
    result = np.empty(len(low), values.dtype)
    width = high - low + 1
    level, span = values, 1
    while True:
        mine = (width >= span) & (width < 2 * span)
        result[mine] = np.minimum(level[low[mine]], level[high[mine] - span + 1])
        if not (width >= 2 * span).any():
            return result
        level = np.minimum(level[:-span], level[span:])
        span *= 2


def anchors(names: np.ndarray, sizes: np.ndarray):
    """Runs of windows with anchors of one name: (name, text number, first, last start, several).

    ``several`` tells that a run has more than one such anchor, as in text that repeats
    itself at once. ``names`` are those of the words of all texts one after the other.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    number = np.maximum(sizes - WINDOW + 1, 0)
    start = np.arange(number.sum()) + np.repeat(begin - (np.cumsum(number) - number), number)
    empty = np.zeros(0, np.int64)
    if not len(start):
        return np.zeros(0, U), empty, empty, empty, empty.astype(bool)
    symbols, lengths, symbol_owner = recompress(names, owner)
    symbol_at = np.repeat(np.arange(len(symbols)), lengths)
    low, high = symbol_at[start + EDGE - 1] + 1, symbol_at[start + WINDOW - EDGE] - 1

    rounds = [(1, symbols)]
    for step in (1, 2, 4):
        own = rounds[-1][1]
        rounds.append((2 * step, mix(own[:-step], own[step:], 20 + step)))
    group = 1 << np.minimum(np.log2(high - low + 1).astype(np.int64), 3)
    place, name = np.empty(len(start), np.int64), np.empty(len(start), U)
    for size, own in rounds:
        mine = group == size
        if not mine.any():
            continue
        rank = np.empty(len(own), np.int64)
        order = np.argsort(own, kind="stable")
        rank[order] = np.arange(len(own))
        found = order[least_in_ranges(rank, low[mine], high[mine] - size + 1)]
        place[mine] = found * 16 + size
        name[mine] = mix(own[found], own[found], 30 + size)
    text = np.repeat(np.arange(len(sizes)), number)
    first = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(first[1:], len(start)) - 1
    at = start - begin[text]
    return name[first], text[first], at[first], at[last], place[first] != place[last]


def window_names(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two names of the window at each start, by naming pairs over doubling lengths."""
    result = []
    for lane in (0, 1):
        v = lanes[:, lane]
        for step in (1, 2, 4, 8, 16):
            v = mix(v[:-step], v[step:], 40 + lane)
        rest = WINDOW - 32
        result.append(mix(v[:-rest], v[rest:], 50 + lane))
    return result[0], result[1]


def chunks(texts: list[str]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive texts, about as many at a time as ``CHUNK_WORDS``."""
    waiting, words, first = [], 0, 0
    for k, text in enumerate(texts):
        waiting.append((text or "").encode().split())
        words += len(waiting[-1])
        if words >= CHUNK_WORDS:
            yield first, waiting
            waiting, words, first = [], 0, k + 1
    if waiting:
        yield first, waiting


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def anchor_table(texts: DataFrame) -> DataFrame:
    """name, uid, first, last, several of every run of anchors of ``texts`` (uid, text)."""

    def emit(batches):
        known = WordNames()
        for batch in batches:
            ids = batch.column("uid").to_numpy(zero_copy_only=False)
            for first_text, words in chunks(batch.column("text").to_pylist()):
                sizes = np.array([len(w) for w in words], np.int64)
                names = known.of([w for one in words for w in one])[:, 0]
                name, text, first, last, several = anchors(names, sizes)
                spans = pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))
                arrays = [signed(name), pa.array(ids[first_text + text]), *spans, pa.array(several)]
                yield pa.RecordBatch.from_arrays(arrays, ["name", "uid", "first", "last", "several"])

    return texts.mapInArrow(emit, "name long, uid long, first int, last int, several boolean")


def spans(ranges: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last starts of all ranges, and where those of each row begin."""
    flat = ranges.flatten()
    sizes = np.diff(ranges.offsets.to_numpy())
    first, last = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
    return first, last, np.concatenate([[0], np.cumsum(sizes)])


def window_table(marked: DataFrame) -> DataFrame:
    """h1, h2, id, start of every window in the ``ranges`` of ``marked`` texts."""

    def emit(batches):
        known = WordNames()
        for batch in batches:
            ids = batch.column("id").to_numpy()
            first, last, offsets = spans(batch.column("ranges"))
            for begin, words in chunks(batch.column("text").to_pylist()):
                lanes = known.of([w for one in words for w in one])
                sizes = np.array([len(w) for w in words])
                ends = np.cumsum(sizes)
                if ends[-1] < WINDOW:
                    continue
                change = np.zeros(ends[-1] + 1, np.int64)
                for k, end in enumerate(ends):
                    own = slice(offsets[begin + k], offsets[begin + k + 1])
                    np.add.at(change, end - sizes[k] + first[own], 1)
                    np.add.at(change, end - sizes[k] + last[own] + 1, -1)
                text = np.repeat(np.arange(len(sizes)), sizes)
                start = np.flatnonzero(np.cumsum(change[:-1]) > 0)
                start = start[start + WINDOW <= ends[text[start]]]
                one, two = window_names(lanes)
                at = (start - (ends - sizes)[text[start]]).astype(np.int32)
                arrays = [signed(one[start]), signed(two[start]), pa.array(ids[begin + text[start]]), pa.array(at)]
                yield pa.RecordBatch.from_arrays(arrays, ["h1", "h2", "id", "start"])

    return marked.mapInArrow(emit, "h1 long, h2 long, id long, start int")


def once_in_a_row(texts: DataFrame) -> DataFrame:
    """Drop rows whose text is that of the row before; saves work on copies that lie together."""

    def emit(batches):
        before = None
        for batch in batches:
            keep = []
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist(), strict=True):
                keep.append((uid, text) != before)
                before = (uid, text)
            yield batch.filter(pa.array(keep))

    return texts.mapInArrow(emit, texts.schema)


def without_repeats(marked: DataFrame) -> DataFrame:
    """digest, n_removed, kept (words left, joined by spaces) from texts and window starts."""

    def emit(batches):
        for batch in batches:
            removed, kept = [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts"), strict=True):
                words = (text or "").encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.asarray(starts.values))
                change[at] += 1
                change[at + WINDOW] -= 1
                covered = np.cumsum(change[:-1]) > 0
                removed.append(int(covered.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~covered)]).decode())
            arrays = [batch.column("digest"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["digest", "n_removed", "kept"])

    return marked.select("digest", "text", "starts").mapInArrow(emit, "digest string, n_removed long, kept string")


@F.arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("sha", T.StringType())]))
def words_and_hash(texts: pa.Array) -> pa.Array:
    """Number of words and SHA-256 of the words joined by spaces."""
    counts, sums = [], []
    for text in texts.to_pylist():
        words = (text or "").encode().split()
        counts.append(len(words))
        sums.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(sums, pa.string())], ["n_words", "sha"])


def repeated_stretches(texts: DataFrame) -> DataFrame:
    """digest, n_removed, kept of each distinct text (digest, uid, text) that loses words.

    Copies of a text count as one here; the caller treats texts that have copies.
    """
    spark = texts.sparkSession
    found, found_path = saved(anchor_table(texts.select("uid", "text")), "substring-anchors")
    where = F.xxhash64("uid", "first")
    places = found.select("name", "several", where.alias("place")).groupBy("name")
    bounds = F.min("place").alias("low"), F.max("place").alias("high"), F.bool_or("several").alias("several")
    again = places.agg(*bounds).where("low <> high or several").select("name")
    # Stored, so that the join has two plain sides and AQE can split a name many texts have.
    again, again_path = saved(again, "substring-names")
    # Copies give the same ranges; distinct first, so that a list is no longer than its text.
    ranges = (
        found.join(again.hint("merge"), "name")
        .select("uid", "first", "last")
        .distinct()
        .groupBy("uid")
        .agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    )
    ranges, ranges_path = saved(ranges, "substring-ranges")
    discard(spark, found_path, again_path)
    candidates = once_in_a_row(texts.join(ranges.hint("merge"), "uid").select("uid", "digest", "text", "ranges"))
    marked, marked_path = saved(candidates.withColumn("id", F.monotonically_increasing_id()), "substring-texts")
    discard(spark, ranges_path)

    windows = window_table(marked.select("id", "text", "ranges"))
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    # Stored for the same reason as the names above.
    twice, twice_path = saved(twice, "substring-windows")
    starts = windows.join(twice.hint("merge"), ["h1", "h2"]).groupBy("id").agg(F.collect_list("start").alias("starts"))
    left, _ = saved(without_repeats(marked.join(starts.hint("merge"), "id")), "substring-left")
    discard(spark, marked_path, twice_path)
    return left


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    A word goes if a window of 35 words that covers it also starts anywhere else. A null
    text has no words; texts of fewer than 35 words lose none; repeated rows and copies
    lose all if long enough. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.md5(text).alias("digest"), F.xxhash64(text).alias("uid"))
    counted = texts.select("doc_id", "digest", words_and_hash("text").alias("w")).select("doc_id", "digest", "w.*")
    summary, _ = saved(counted, "substring-summary")
    copies = summary.groupBy("digest").agg(F.count("*").alias("n"), F.first("n_words").alias("words"))
    copies = copies.where((F.col("n") > 1) & (F.col("words") >= WINDOW)).select("digest", F.lit(True).alias("copied"))
    left = repeated_stretches(texts.select("digest", "uid", "text"))
    left = left.select("digest", "n_removed", F.sha2("kept", 256).alias("kept")).dropDuplicates(["digest"])
    changes, _ = saved(left.join(copies, "digest", "full_outer"), "substring-changes")
    return summary.join(changes, "digest", "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
