"""Ranked lexical search without random access (NRA) over a document-partitioned index.

A postings list holds the impact of its term on the score of each document, largest first.
Lists are read in parallel in steps of falling impact. What has been read of a document
bounds its score from below; adding, for the terms not yet met, the largest impact still
unread bounds it from above. Reading admits new documents until the unread impacts of all
terms together fall below the k-th best lower bound, and then goes on for documents whose
interval still reaches that bound, until their intervals have closed.

Scores add up over documents, not between them, so the index is dealt by document: each
block of documents gives its own k best for every query, and the best of those are the
answer. Only the number of documents, their terms and the terms' document counts are shared.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmart.llm.common import discard, saved

TOP = 10
#: Bits of the map of query terms that tasks screen words with: 1 MB whatever the number of queries.
MAP_BITS = 1 << 23
#: Postings of one block of documents, in memory of one task.
BLOCK_POSTINGS = 1 << 21
#: Terms of the queries that are answered together, with a query on top: bounds what is sent to tasks.
QUERY_TERMS = 1 << 17
#: Each step reads impacts down to this part of the last step's.
STEP = 0.5
#: Letters and digits of ASCII and every other character; as bytes of UTF-8, after lower-casing.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LAST_ID = (1 << 63) - 1


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of term characters; only A-Z are lower-cased."""
    return TERM.findall((text or "").encode().lower())


def places(terms: list[bytes]) -> np.ndarray:
    """Bit of each term in the map of query terms."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(term) & (MAP_BITS - 1) for term in terms), np.int64, len(terms))


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """query (a number per row of ``queries``), key, term: the distinct terms of each query."""

    def split(batches):
        for batch in batches:
            found = [sorted(set(terms_of(x))) for x in batch.column(2).to_pylist()]
            owner = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            terms = pa.array([term.decode() for x in found for term in x], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)), terms],
                names=["query", "key", "term"],
            )

    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(key).cast("long").alias("key"), text)
    return rows.mapInArrow(split, "query long, key long, term string")


def term_map(terms: DataFrame) -> np.ndarray:
    """Bits of all terms of all queries, of fixed size."""

    def mark(batches):
        bits = np.zeros(MAP_BITS // 8, np.uint8)
        for batch in batches:
            at = places([term.encode() for term in batch.column(0).to_pylist()])
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].astype(np.int64))], names=["at", "bits"])

    parts = terms.select("term").mapInArrow(mark, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    whole = np.zeros(MAP_BITS // 8, np.uint8)
    marked = parts.toArrow()
    whole[marked.column("at").to_numpy()] = marked.column("bits").to_numpy()
    return whole


INDEX_SCHEMA = "doc_id long, n long, terms array<string>, times array<long>"


def term_counts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """doc_id, number of terms, and those that queries may have with their occurrences, per row with terms."""

    def count(batches):
        known: dict[bytes, bool] = {}

        def wanted(term: bytes) -> bool:
            answer = known.get(term)
            if answer is None:
                if len(known) >= MAP_BITS // 8:
                    known.clear()
                at = int(places([term])[0])
                answer = known[term] = bool(bits[at >> 3] >> (at & 7) & 1)
            return answer

        for batch in batches:
            total, terms, times = [], [], []
            for text in batch.column(1).to_pylist():
                found = terms_of(text)
                counted = [(term, number) for term, number in Counter(found).items() if wanted(term)]
                total.append(len(found))
                terms.append([term.decode() for term, _ in counted])
                times.append([number for _, number in counted])
            held = pa.array([n > 0 for n in total], pa.bool_())
            columns = [batch.column(0), pa.array(total, pa.int64())]
            columns += [pa.array(terms, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"]).filter(held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, INDEX_SCHEMA)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Part of the score that a term gives a document, in whole numbers."""
    scale = 100 - 90 + 90 * lengths * documents // words
    return weights * (1_000_000_000 * times // (1000 * times + 8 * scale))


@dataclass(frozen=True)
class Lists:
    """Postings of a block of documents: per term a stretch of ``docs`` by falling impact.

    Impacts are kept as negative numbers, so that a stretch ascends and can be searched.
    """

    starts: np.ndarray
    docs: np.ndarray
    minus: np.ndarray

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.starts[term], self.starts[term + 1]
        return self.docs[low:high], self.minus[low:high]


def sorted_lists(terms: np.ndarray, docs: np.ndarray, values: np.ndarray, vocabulary: int) -> Lists:
    kept = values > 0
    order = np.lexsort((-values[kept], terms[kept]))
    starts = np.concatenate([[0], np.cumsum(np.bincount(terms[kept], minlength=vocabulary))])
    return Lists(starts, docs[kept][order], -values[kept][order])


def best_by_intervals(lists: Lists, terms: np.ndarray, ids: np.ndarray, lower: np.ndarray, top: int) -> list[tuple[int, int]]:
    """(document, score) of the ``top`` best of a block, equal scores by id.

    ``lower`` is a vector of zeros as long as the block, and is zeros again afterwards.
    """
    own = [pair for pair in map(lists.of, terms) if len(pair[0])]
    if not own:
        return []

    def kth(scores: np.ndarray) -> int:
        cut = len(scores) - top
        return int(np.partition(scores, cut)[cut]) if cut >= 0 else 0

    read = [0] * len(own)
    heads = np.array([-minus[0] for _, minus in own])
    limit, bound = int(heads.max()), 0
    # New documents come in as long as one never met could still reach the k-th best.
    while heads.any() and int(heads.sum()) >= bound:
        limit = int(limit * STEP)
        for k, (docs, minus) in enumerate(own):
            stop = int(np.searchsorted(minus, -limit, "right"))
            if stop > read[k]:
                lower[docs[read[k] : stop]] -= minus[read[k] : stop]
                read[k] = stop
                heads[k] = -minus[stop] if stop < len(minus) else 0
        seen = np.flatnonzero(lower)
        bound = kth(lower[seen])

    # Upper bounds: heads of the lists that have not met the document yet.
    position = np.full(len(lower), -1, np.int64)
    position[seen] = np.arange(len(seen))
    scores, open_ = lower[seen], np.full(len(seen), heads.sum(), np.int64)
    lower[seen] = 0
    met = []
    for k, (docs, _) in enumerate(own):
        at = position[docs[: read[k]]]
        open_[at] -= heads[k]
        met.append(at)
    alive = scores + open_ >= bound
    while heads.any() and (open_[alive] > 0).any():
        # Only documents whose interval reaches the bound are followed; each step narrows intervals.
        ours = np.flatnonzero(alive)
        position[:] = -1
        position[seen[ours]] = np.arange(len(ours))
        met = [(lambda at: at[at >= 0])(position[seen[at]]) for at in met]
        seen, scores, open_ = seen[ours], scores[ours], open_[ours]
        limit = int(limit * STEP)
        for k, (docs, minus) in enumerate(own):
            if not heads[k]:
                continue
            stop = int(np.searchsorted(minus, -limit, "right"))
            at = position[docs[read[k] : stop]]
            held = at >= 0
            at = at[held]
            scores[at] -= minus[read[k] : stop][held]
            open_[at] -= heads[k]
            met[k] = np.concatenate([met[k], at])
            head = int(-minus[stop]) if stop < len(minus) else 0
            if head != heads[k]:
                open_ -= heads[k] - head
                open_[met[k]] += heads[k] - head
            read[k], heads[k] = stop, head
        bound = max(bound, kth(scores))
        alive = scores + open_ >= bound
    final = np.flatnonzero(alive)
    order = np.lexsort((ids[seen[final]], -scores[final]))[:top]
    return [(int(seen[final[x]]), int(scores[final[x]])) for x in order]


def searched(index: DataFrame, block: list[tuple[int, int, str, int]], documents: int, words: int, top: int) -> DataFrame:
    """query, key, doc_id, score: the best of every block of documents for each query of ``block``.

    ``block`` has (query, key, term, weight); it is bounded by the caller.
    """
    vocabulary = {term: k for k, term in enumerate(sorted({term for _, _, term, _ in block}))}
    weights = np.zeros(len(vocabulary), np.int64)
    queries: dict[tuple, list[int]] = {}
    for query, key, term, own in block:
        weights[vocabulary[term]] = own
        queries.setdefault((query, key), []).append(vocabulary[term])
    asked = [(query, np.array(terms)) for query, terms in queries.items()]

    def answer(batches):
        parts, size, first = [], 0, 0
        for batch in batches:
            held = batch.column("terms").flatten().to_pylist()
            number = np.fromiter((vocabulary.get(term, -1) for term in held), np.int64, len(held))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("terms").offsets.to_numpy()))
            times = batch.column("times").flatten().to_numpy()
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy()
            lengths = batch.column("n").to_numpy()
            ours = number >= 0
            number, owner, times = number[ours], owner[ours], times[ours]
            parts.append((number, owner + first, impacts(weights[number], times, lengths[owner], documents, words), ids))
            size, first = size + len(number), first + batch.num_rows
            if size >= BLOCK_POSTINGS:
                yield best(parts, first)
                parts, size, first = [], 0, 0
        if first:
            yield best(parts, first)

    def best(parts, rows):
        number, owner, values, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        lists = sorted_lists(number, owner, values, len(vocabulary))
        zeros = np.zeros(rows, np.int64)
        found = [
            (query, key, int(ids[doc]), score)
            for (query, key), terms in asked
            for doc, score in best_by_intervals(lists, terms, ids, zeros, top)
        ]
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        arrays = [pa.array(column, pa.int64()) for column in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["query", "key", "doc_id", "score"])

    return index.mapInArrow(answer, "query long, key long, doc_id long, score long")


def query_blocks(terms: DataFrame, limit: int):
    """Rows (query, key, term, w) of whole queries, about ``limit`` rows at a time."""
    block: list = []
    for row in terms.orderBy("query").toLocalIterator():
        if len(block) >= limit and row["query"] != block[-1][0]:
            yield block
            block = []
        block.append((row["query"], row["key"], row["term"], row["w"]))
    if block:
        yield block


def ranked_search(
    docs: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", top: int = TOP, block_terms: int = QUERY_TERMS
) -> DataFrame:
    """``key``, rank, doc_id, score: the ``top`` best rows of ``docs`` for every row of ``queries``.

    Null and empty texts, and texts without terms, hold nothing: they are not counted and
    not found; such a query finds nothing. Every row is a document of its own, repeated ones
    too, and every row of ``queries`` a query of its own. Equal scores are ranked by doc_id,
    null ids last. Scores of zero are not returned. Other columns are not read.
    """
    spark = docs.sparkSession
    asked, asked_path = saved(query_terms(queries, key, text), "search-queries")
    index, index_path = saved(term_counts(docs, term_map(asked)), "search-index", "zstd")
    documents, words = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # Few distinct counts: the logarithm is taken once for each of them.
    weights = F.udf(lambda df: weight(documents, df), "long")
    by_count, counts_path = saved(asked.join(holding, "term").select("query", "key", "term", "df"), "search-terms")
    weighed = by_count.join(by_count.select("df").distinct().select("df", weights("df").alias("w")), "df")
    found = None
    for block in query_blocks(weighed, block_terms):
        part = searched(index, block, documents, words, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query long, key long, doc_id long, score long")
    found, _ = saved(found, "search-found")
    discard(spark, asked_path, index_path, counts_path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("key").alias(key), "rank", F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), "score")
