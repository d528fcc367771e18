"""Alignment of the tokens of two tokenizers over the bytes of each text.

A byte-level tokenizer A and a SentencePiece tokenizer B spell the same bytes (a space and
the text). Offsets where tokens of both end cut them into groups. Most groups are one token
of A over one token of B, which then have the same bytes: B's id is known from A's by an
array made once, so documents that hold such a pair are counted in a vector as long as A's
vocabulary. Pairs of other groups are counted by a shuffle of pairs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.llm.common import discard, per_worker, saved

#: The most frequent pairs of other groups that are looked up in each task: bounds what is sent there (6 MB).
HEAD_PAIRS = 1 << 18
#: Fixed value: how byte-level tokenizers of this kind split a text into words.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Low bits of a number that holds a place in the batch and a pair.
PAIR_BITS = 40


@dataclass(frozen=True)
class Tokens:
    """Bytes of every id of both tokenizers and, per id of A, the id of B with the same bytes or -1."""

    a_bytes: list[bytes]
    b_bytes: list[bytes]
    same: np.ndarray

    @property
    def a_sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.a_bytes], np.int64)

    @property
    def b_sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.b_bytes], np.int64)


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: itself if it is visible."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {**{chr(byte): byte for byte in visible}, **{chr(256 + k): byte for k, byte in enumerate(hidden)}}


def byte_entries(a_path: str) -> list[bytes]:
    """Bytes of every id of a byte-level tokenizer file; special tokens are their strings."""
    with open(a_path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    special = {token["id"]: token["content"] for token in content["added_tokens"]}
    ids = {**content["model"]["vocab"], **{text: number for number, text in special.items()}}
    entries = [b""] * (max(ids.values()) + 1)
    for entry, number in ids.items():
        entries[number] = entry.encode() if number in special else bytes(letters[letter] for letter in entry)
    return entries


def byte_encoder(a_path: str):
    """The file's tokenizer as an encoder of ordinary text: special tokens are not looked for.

    Merges rank like the ids of what they make, which is checked, so ids serve as ranks.
    """
    import tiktoken

    with open(a_path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in content["model"]["merges"]]
    made = [vocabulary[first + second] for first, second in merges]
    if made != sorted(made):
        raise ValueError(f"merges of {a_path} do not rank like their ids")
    entries, special = byte_entries(a_path), {token["id"] for token in content["added_tokens"]}
    ranks = {entries[number]: number for number in vocabulary.values() if number not in special}
    return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoders(a_path: str, b_path: str):
    """Both tokenizers, loaded once per worker."""

    def load():
        import sentencepiece

        return byte_encoder(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)

    return per_worker(f"encoders {a_path} {b_path}", load)


def tokens(a_path: str, b_path: str) -> Tokens:
    return per_worker(
        f"tokens {a_path} {b_path}", lambda: table_of(byte_entries(a_path), encoders(a_path, b_path)[1])
    )


def table_of(a_bytes: list[bytes], second) -> Tokens:
    def of_piece(number: int) -> bytes:
        piece = second.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(number) else piece.replace("▁", " ").encode()

    b_bytes = [of_piece(number) for number in range(second.get_piece_size())]
    # A byte that is also a piece is encoded as the piece, so pieces come last and win.
    order = sorted(range(len(b_bytes)), key=lambda number: not second.is_byte(number))
    ids = {b_bytes[number]: number for number in order if not second.is_control(number)}
    return Tokens(a_bytes, b_bytes, np.array([ids.get(x, -1) for x in a_bytes], np.int64))


def written_ids(a_count: int, b_count: int) -> list[bytes]:
    """Ids of A inside and at the end of their part of a group, then those of B."""
    parts = ((a_count, b","), (a_count, b"|"), (b_count, b","), (b_count, b";"))

    def write():
        return [b"%d" % number + mark for count, mark in parts for number in range(count)]

    return per_worker(f"written ids {a_count} {b_count}", write)


@dataclass(frozen=True)
class Aligned:
    """Figures per text and, in order of texts, distinct linked pairs with how often they are linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    owners: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def aligned(texts: list[str | None], a_path: str, b_path: str) -> Aligned:
    """Groups and links of a batch of texts; a pair is ``id of A * size of B's vocabulary + id of B``.

    All texts are laid end to end: both tokenizers cover the same bytes, so offsets of all
    of them are compared at once. Texts that either tokenizer does not spell exactly, null
    and empty texts have no tokens.
    """
    first, second = encoders(a_path, b_path)
    table = tokens(a_path, b_path)
    full = [k for k, text in enumerate(texts) if text]
    own_a = [first.encode_ordinary(" " + texts[k]) for k in full]
    own_b = second.encode([texts[k] for k in full], num_threads=1)
    used, a_lists, b_lists, sizes = [], [], [], []
    for k, a_ids, b_ids in zip(full, own_a, own_b, strict=True):
        spelt = (" " + texts[k]).encode()
        if spelt == b"".join(map(table.a_bytes.__getitem__, a_ids)) == b"".join(map(table.b_bytes.__getitem__, b_ids)):
            used.append(k)
            a_lists.append(a_ids)
            b_lists.append(b_ids)
            sizes.append(len(spelt))
    numbers = [np.zeros(len(texts), np.int64) for _ in range(4)]
    digests = [""] * len(texts)
    if not used:
        none = np.zeros(0, np.int64)
        return Aligned(*numbers, digests, none, none, none)

    place = np.array(used)
    a_count, b_count = (np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
    a, b = (np.concatenate([np.array(x, np.int64) for x in lists]) for lists in (a_lists, b_lists))
    a_ends, b_ends = np.cumsum(table.a_sizes[a]), np.cumsum(table.b_sizes[b])
    text_ends = np.cumsum(sizes)

    cuts = a_ends[np.isin(a_ends, b_ends, assume_unique=True, kind="sort")]
    group_of_a, group_of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    # Tokens of both end somewhere in each stretch between neighbouring ends: one link each.
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])]
    owner = np.searchsorted(text_ends, ends)
    pair = a[np.searchsorted(a_ends, ends)] * len(table.b_bytes) + b[np.searchsorted(b_ends, ends)]
    held, times = np.unique((owner << PAIR_BITS) | pair, return_counts=True)

    n_a, n_b, n_groups, n_links = numbers
    n_a[place], n_b[place] = a_count, b_count
    n_groups[place] = np.bincount(np.searchsorted(text_ends, cuts), minlength=len(used))
    n_links[place] = np.bincount(owner, minlength=len(used))

    # Written form: tokens of A of a group, then those of B, group after group.
    a_in_group, b_in_group = np.bincount(group_of_a), np.bincount(group_of_b)
    a_upto, b_upto = np.cumsum(a_in_group), np.cumsum(b_in_group)
    order = np.empty(len(a) + len(b), np.int64)
    a_all, b_all = len(table.a_bytes), len(table.b_bytes)
    a_last, b_last = np.isin(a_ends, cuts, assume_unique=True), np.isin(b_ends, cuts, assume_unique=True)
    order[np.arange(len(a)) + (b_upto - b_in_group)[group_of_a]] = a + a_last * a_all
    order[np.arange(len(b)) + a_upto[group_of_b]] = b + b_last * b_all + 2 * a_all
    written = written_ids(a_all, b_all).__getitem__
    stops = np.cumsum(a_count + b_count)
    for k, low, high in zip(used, (stops - a_count - b_count).tolist(), stops.tolist(), strict=True):
        digests[k] = hashlib.sha256(b"".join(map(written, order[low:high].tolist()))[:-1]).hexdigest()
    return Aligned(
        n_a, n_b, n_groups, n_links, digests, place[held >> PAIR_BITS], held & ((1 << PAIR_BITS) - 1), times
    )


def lists(owners: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """One list per row from values in order of their rows."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED_SCHEMA = (
    f"row long, doc_id long, {FIGURES}, "
    "same_ids array<int>, same_times array<int>, pairs array<long>, pair_times array<int>"
)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Figures of every row of ``docs`` and its distinct pairs, those of equal bytes by the id of A only."""

    def run(batches):
        table = tokens(a_path, b_path)
        b_all = len(table.b_bytes)
        for batch in batches:
            found = aligned(batch.column("text").to_pylist(), a_path, b_path)
            same = table.same[found.pairs // b_all] == found.pairs % b_all
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    *(pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)),
                    pa.array(found.digests, pa.string()),
                    lists(found.owners[same], found.pairs[same] // b_all, rows, pa.int32()),
                    lists(found.owners[same], found.times[same], rows, pa.int32()),
                    lists(found.owners[~same], found.pairs[~same], rows, pa.int64()),
                    lists(found.owners[~same], found.times[~same], rows, pa.int32()),
                ],
                names=[part.split()[0] for part in ALIGNED_SCHEMA.split(", ")],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, ALIGNED_SCHEMA)


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a list column without nulls."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy()


def documents_per_pair(found: DataFrame, same: np.ndarray, b_all: int) -> DataFrame:
    """pair, same, n: how many rows hold the pair. Pairs of equal bytes are counted in one vector per task."""

    def count(batches):
        vector = np.zeros(len(same), np.int64)
        for batch in batches:
            vector += np.bincount(flat(batch.column(0))[1], minlength=len(same))
        ids = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(ids * b_all + same[ids]), pa.array(vector[ids])], names=["pair", "n"])

    vectors = found.select("same_ids").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    others = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return vectors.select("pair", F.lit(True).alias("same"), "n").union(others.select("pair", F.lit(False), "n"))


def numpy_columns(df: DataFrame) -> list[np.ndarray]:
    """Columns of a table known to be small."""
    return [column.to_numpy() for column in df.toArrow().columns]


def cross_tokenizer(docs: DataFrame, a_path: str, b_path: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose bytes a tokenizer does not spell exactly, have
    zeros and an empty digest. Every row counts as a document, repeated ones each; a null
    doc_id stays null. Equal highest counts of an id of A all count as best. Other columns
    are not read; an empty table gives no rows.

    Counts of pairs of equal bytes (at most one per id of A) and of the ``head_pairs`` most
    frequent others are looked up in every task, so that no hot pair is joined; the others
    are joined by pair.
    """
    spark: SparkSession = docs.sparkSession
    table = tokens(a_path, b_path)
    b_all, same = len(table.b_bytes), table.same
    found, found_path = saved(align(docs, a_path, b_path), "aligned", "zstd")
    counts, counts_path = saved(documents_per_pair(found, same, b_all), "aligned-counts")
    numbered = counts.withColumn("a", F.expr(f"pair div {b_all}"))
    best = numbered.groupBy("a").agg(F.max("n").alias("best"))
    is_best = (F.col("n") == F.col("best")).cast("long").alias("is_best")
    ranked, ranked_path = saved(numbered.join(best, "a").select("a", "pair", "same", "n", is_best), "aligned-best")

    ids, same_n, same_best = numpy_columns(ranked.where("same").select("a", "n", "is_best"))
    of_same, best_same = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    of_same[ids], best_same[ids] = same_n, same_best
    frequent = ranked.where("not same").orderBy(F.desc("n"), "pair").limit(head_pairs)
    head, head_n, head_best = numpy_columns(frequent.select("pair", "n", "is_best").orderBy("pair"))

    def sums(batches):
        for batch in batches:
            rows = batch.num_rows
            owner, ids = flat(batch.column("same_ids"))
            times = batch.column("same_times").flatten().to_numpy().astype(np.int64)
            total, good = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(total, owner, times * of_same[ids])
            np.add.at(good, owner, times * best_same[ids])
            owner, pairs = flat(batch.column("pairs"))
            times = batch.column("pair_times").flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(head, pairs), max(len(head) - 1, 0))
            known = head[at] == pairs if len(head) else np.zeros(len(pairs), bool)
            np.add.at(total, owner[known], times[known] * head_n[at[known]])
            np.add.at(good, owner[known], times[known] * head_best[at[known]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(good),
                    pa.array(total),
                    lists(owner[~known], pairs[~known], rows, pa.int64()),
                    lists(owner[~known], times[~known], rows, pa.int64()),
                ],
                names=["row", "good", "total", "pairs", "times"],
            )

    held = found.select("row", "same_ids", "same_times", "pairs", "pair_times")
    looked, looked_path = saved(
        held.mapInArrow(sums, "row long, good long, total long, pairs array<long>, times array<long>"), "aligned-sums"
    )
    left = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("at")).select("row", "at.pairs", "at.times")
    joined = left.join(ranked, left["pairs"] == ranked["pair"]).selectExpr(
        "row", "times * is_best as good", "times * n as total"
    )
    by_row = joined.unionByName(looked.select("row", "good", "total")).groupBy("row")
    by_row, _ = saved(by_row.agg(F.sum("good").alias("n_best"), F.sum("total").alias("count_sum")), "aligned-rows")
    discard(spark, counts_path, ranked_path, looked_path)
    figures = [part.split()[0] for part in FIGURES.split(", ")]
    return found.select("row", "doc_id", *figures).join(by_row, "row").drop("row")
