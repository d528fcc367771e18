"""MinHash near-duplicates: banded candidates, sequential Bayesian verification, exact check.

A text is the set of its five-word shingles; texts of equal sets are one class. The
signature of a class holds one byte of the minimum under each of many permutations; eight
bytes make a band, and classes that agree in a band meet in a cell. Candidates compare their
signatures batch by batch: after n bytes of which m agree, the probability that the whole
similarity reaches the threshold follows from a flat prior, and a pair is dropped as soon as it
is below the chosen miss probability. Whatever survives is decided by the whole sets.

Classes of a cell are not paired with each other at once. In each round every member meets a
few representatives of its cells: first those that meet the most others themselves, which are
the least changed of many variants, then others by chance. What is linked becomes one
component, and cells whose members are all in one component are done. Members of different
components that are left after the rounds bring their whole sets and meet each other, block
against block, within one task: what survives verification is decided there, the most alike
candidates first, unless the group's links have joined the two by then. A crowd whose members
are alike but not similar enough costs comparisons, not rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.llm.common import discard, one_row_each, saved
from trailmart.llm.components import components

SHINGLE_WORDS = 5
HASH_SEED = 42
#: Least similarity of linked sets, in per cent.
PERCENT = 85
#: A pair at the threshold shares none of the bands with probability 7.6e-7.
BANDS, BAND_BYTES = 44, 8
#: Bytes that are compared at a time.
BATCH = 32
#: Probability at which a pair that reaches the threshold may be dropped after a batch.
MISS = 1e-7
#: Rounds in which members of a cell meet representatives, and how many of them at most.
ROUNDS, REPRESENTATIVES = 3, 4
#: Members of one cell that meet in one group; larger cells are compared block against block.
CELL_ROWS = 512
CHUNK_SHINGLES = 2048
#: Pairs whose signatures are compared at once, whole sets at once.
CHUNK_PAIRS = 1 << 14
SPACE = re.compile(rb"[^\x20\x09-\x0d]+")
#: Stands for a null doc_id, which counts only where a component has no other.
LAST_ID = (1 << 63) - 1


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, without words none."""
    from xxhash import xxh64_intdigest

    words = SPACE.findall((text or "").encode().lower())
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return np.array([xxh64_intdigest(joined, HASH_SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-SHINGLE_WORDS]]).tolist()
    last = (ends[SHINGLE_WORDS - 1 :] - 1).tolist()
    hashes = [xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(starts, last, strict=True)]
    return np.unique(np.array(hashes, np.uint64))


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Fixed factors and offsets, one of each per byte of the signature."""
    from xxhash import xxh64_intdigest

    numbers = np.array([xxh64_intdigest(b"%d" % k, 7) for k in range(2 * BANDS * BAND_BYTES)], np.uint64)
    factors, offsets = (numbers & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(2, -1)
    return factors | np.uint32(1), offsets


def signature(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bands of a set as 64-bit numbers, each made of one byte of eight minima; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(short), CHUNK_SHINGLES):
        part = short[low : low + CHUNK_SHINGLES, None]
        np.minimum(least, ((part ^ offsets) * factors).min(axis=0), out=least)
    mixed = least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(56)).astype(np.uint8).view(np.int64)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


MARKS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


@F.arrow_udf(MARKS)
def marks(texts: pa.Array) -> pa.Array:
    """Name and size of the shingle set, and its signature."""
    from xxhash import xxh3_128_hexdigest

    factors, offsets = permutations()
    sets = [shingle_hashes(text) for text in texts.to_pylist()]
    names = pa.array([xxh3_128_hexdigest(x.tobytes()) for x in sets], pa.string())
    sizes = pa.array([len(x) for x in sets], pa.int64())
    bands = lists([signature(x, factors, offsets) for x in sets])
    return pa.StructArray.from_arrays([names, sizes, bands], ["name", "size", "bands"])


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingle_set(texts: pa.Array) -> pa.Array:
    return lists([shingle_hashes(text) for text in texts.to_pylist()])


def least_agreement(percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """Per batch, the fewest bytes that must have agreed so far.

    With a flat prior of the similarity s the posterior after m of n agreements is
    Beta(m + 1, n - m + 1), whose tail above t is the probability of at most m successes in
    n + 1 draws at t. Bytes of different minima agree by chance, so t is a little higher.
    """
    t = percent / 100 + (1 - percent / 100) / 256
    needed = []
    for n in range(BATCH, BANDS * BAND_BYTES + 1, BATCH):
        tail, term, m = 0.0, (1 - t) ** (n + 1), 0
        while m <= n:
            tail += term
            if tail >= miss:
                break
            term *= (n + 1 - m) / (m + 1) * t / (1 - t)
            m += 1
        needed.append(m)
    return np.array(needed)


def may_be_similar(left: np.ndarray, right: np.ndarray, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two byte matrices survive every batch, and how many of their bytes agree."""
    agreed = np.zeros(len(left), np.int64)
    alive = np.arange(len(left))
    for number, least in enumerate(needed):
        part = slice(number * BATCH, (number + 1) * BATCH)
        agreed[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[agreed[alive] >= least]
    return alive, agreed[alive]


def bytes_of(column: pa.Array) -> np.ndarray:
    """Signatures of a batch as a matrix of bytes."""
    return column.flatten().to_numpy().view(np.uint8).reshape(len(column), BANDS * BAND_BYTES)


def surviving(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """u, v of the pairs that sequential verification does not rule out.

    ``pairs`` come dealt by u, so only the join by v moves them.
    """
    needed = least_agreement()

    def screen(batches):
        for batch in batches:
            left, right = bytes_of(batch.column("bands_u")), bytes_of(batch.column("bands_v"))
            kept = pa.array(may_be_similar(left, right, needed)[0])
            yield pa.RecordBatch.from_arrays([batch.column("u").take(kept), batch.column("v").take(kept)], names=["u", "v"])

    first = signatures.select(F.col("node").alias("u"), F.col("bands").alias("bands_u"))
    second = signatures.select(F.col("node").alias("v"), F.col("bands").alias("bands_v"))
    both = pairs.join(first.hint("merge"), "u").join(second.hint("merge"), "v")
    return both.select("u", "v", "bands_u", "bands_v").mapInArrow(screen, "u long, v long")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v of the pairs whose whole sets are similar enough."""
    first = sets.select(F.col("node").alias("u"), F.col("shingles").alias("set_u"))
    second = sets.select(F.col("node").alias("v"), F.col("shingles").alias("set_v"))
    both = pairs.join(first.hint("merge"), "u").join(second.hint("merge"), "v")
    common = F.size(F.array_intersect("set_u", "set_v")).cast("long")
    union = F.size("set_u") + F.size("set_v") - common
    return both.where(common * 100 >= union * PERCENT).select("u", "v")


def with_components(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """cell, node, met, comp of every member; nodes without links are components of their own."""
    rooted = members.withColumn("root", F.col("node")) if roots is None else members.join(roots, "node", "left")
    return rooted.select(F.explode("cells").alias("cell"), "node", "met", F.coalesce("root", "node").alias("comp"))


def open_cells(members: DataFrame) -> DataFrame:
    """Members of cells whose members are not all in one component, with the cell's size."""
    ends = members.groupBy("cell").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"))
    return members.join(ends.where("low < high").select("cell", "n"), "cell")


def pairs_with_representatives(members: DataFrame, number: int) -> DataFrame:
    """u, v: every member with the first few representatives its cells have in this round, if of another component.

    A pair comes twice where both represent a cell of the other.
    """
    chance = F.xxhash64("node", F.lit(number))
    order = F.struct((-F.col("met") if number == 0 else F.lit(0).cast("long")).alias("met"), chance.alias("chance"))
    chosen = members.groupBy("cell").agg(F.min(F.struct(order.alias("order"), "node", "comp")).alias("r"))
    met = members.join(chosen, "cell").where(F.col("comp") != F.col("r.comp"))
    # A node has at most one representative per band.
    first = F.slice(F.array_sort(F.collect_set(F.struct("r.order", "r.node"))), 1, REPRESENTATIVES)
    few = met.groupBy(F.col("node").alias("u")).agg(first.alias("few"))
    return few.select("u", F.explode("few.node").alias("v"))


def blocked(members: DataFrame, limit: int) -> DataFrame:
    """Adds ``pair``: cells above ``limit`` members are cut into blocks that meet pairwise."""
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("long")
    dealt = members.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    return dealt.select("cell", pair.alias("pair"), "node", "comp")


def places_in_lists(owner: np.ndarray, of: np.ndarray, agreed: np.ndarray) -> np.ndarray:
    """Place of each pair among the candidates of one member in one component, most alike first."""
    order = np.lexsort((-agreed, of, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (of[order][1:] == of[order][:-1])
    begins = np.flatnonzero(np.append(True, ~same))
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return places


def sets_of(column: pa.Array) -> list[np.ndarray]:
    """Sorted hashes of each row of a batch."""
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(column.flatten().to_numpy().view(np.uint64), ends[:-1])


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    small, large = sorted((left, right), key=len)
    if len(small) * 100 < len(large) * PERCENT:
        return False
    places = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[places] == small).sum())
    return common * 100 >= (len(left) + len(right) - common) * PERCENT


def links_in_cells(rows: DataFrame) -> DataFrame:
    """u, v: links that join members of a group that are of different components.

    Pairs that survive verification are decided by their whole sets, in order of their places
    among the candidates that a member has in another component; one that earlier links of the
    group have joined already needs no decision. ``rows`` has cell, pair, node, comp, bands,
    shingles. Groups are read one after the other, and only links leave the task.
    """
    needed = least_agreement()
    schema = "u long, v long"

    def compare(batches):
        waiting: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            keys = np.stack([batch.column("cell").to_numpy(), batch.column("pair").to_numpy()], axis=1)
            if not len(keys):
                continue
            changes = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for start, end in zip([0, *changes], [*changes, len(keys)], strict=True):
                own = tuple(keys[start])
                if own != current and waiting:
                    yield group(waiting)
                    waiting = []
                current = own
                waiting.append(batch.slice(start, end - start))
        if waiting:
            yield group(waiting)

    def group(batches):
        node, comp = (np.concatenate([x.column(c).to_numpy() for x in batches]) for c in ("node", "comp"))
        bands = np.concatenate([bytes_of(x.column("bands")) for x in batches])
        sets = [one for x in batches for one in sets_of(x.column("shingles"))]
        # A pair that meets in several bands is compared in the first of them alone.
        parts = bands.view(np.int64)
        band = int((parts == parts[0]).all(axis=0).argmax())
        step = max(1, CHUNK_PAIRS // len(node))
        found = []
        for begin in range(0, len(node), step):
            # Each unordered pair once: rows of this stretch with all rows after them.
            a, b = np.nonzero(comp[begin : begin + step, None] != comp[None, :])
            a += begin
            a, b = a[a < b], b[a < b]
            first = (parts[a] == parts[b]).argmax(axis=1) == band
            a, b = a[first], b[first]
            kept, agreed = may_be_similar(bands[a], bands[b], needed)
            found.append((a[kept], b[kept], agreed))
        a, b, agreed = (np.concatenate(x) for x in zip(*found, strict=True))
        place = np.maximum(places_in_lists(a, comp[b], agreed), places_in_lists(b, comp[a], agreed))
        order, joined, links = np.argsort(place, kind="stable"), comp.copy(), []
        for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
            if joined[i] != joined[j] and similar(sets[i], sets[j]):
                links.append((i, j))
                joined[joined == joined[j]] = joined[i]
        u, v = (node[[link[side] for link in links]] if links else np.zeros(0, np.int64) for side in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    sorted_rows = rows.repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    return sorted_rows.mapInArrow(compare, schema).distinct()


def near_duplicates(docs: DataFrame, cell_rows: int = CELL_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, tie (text hash), n_shingles, component_id, kept, chosen of every row of ``docs``.

    Sets are linked at a similarity of ``PERCENT`` or more. ``component_id`` is the smallest
    doc_id reachable; null ids count only where a component has no other. Null texts and texts
    without words have no shingles and are linked with nothing, not even each other. ``kept``
    marks rows whose doc_id is that of their component, ``chosen`` the rows equal to the one it
    stands for. Repeated rows repeat in the result. Other columns are not read; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    own_id, tie = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("tie")
    marked, _ = saved(docs.select(own_id, tie, marks(F.col("text")).alias("m")), "minhash-marks")
    rows = marked.select("id", "tie", "m.*")
    first = F.min(F.struct("id", "tie")).alias("first")
    classes = rows.where("size > 0").groupBy("name").agg(first, F.any_value("bands").alias("bands"))
    classes, classes_path = saved(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    banded = classes.select("node", F.posexplode("bands").alias("band", "part"))
    cells = banded.select(F.xxhash64("band", "part").alias("cell"), "node")
    crowded = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = cells.join(crowded, "cell").groupBy("node").agg(F.collect_list("cell").alias("cells"), F.sum("n").alias("met"))
    members, members_path = saved(shared, "minhash-members")

    # Signatures and whole sets of classes that meet others, from one text each.
    wanted = classes.join(members.select("node"), "node", "left_semi").select("node", "bands", "first.id", "first.tie")
    texts = docs.select(own_id, tie, "text").join(wanted.hint("merge"), ["id", "tie"])
    # Rows of a text lie together already.
    once = texts.groupBy("id", "tie", "node").agg(F.any_value("bands").alias("bands"), F.any_value("text").alias("text"))
    sets, sets_path = saved(once.select("node", "bands", shingle_set(F.col("text")).alias("shingles")), "minhash-sets")
    signatures, finished = sets.select("node", "bands"), [members_path, sets_path]

    roots, number = None, 0
    while number <= rounds:
        placed = with_components(members, roots)
        if number < rounds:
            candidates = surviving(pairs_with_representatives(placed, number), signatures)
            candidates, path = saved(candidates, f"minhash-candidates-{number}")
            finished.append(path)
            fresh = confirmed(candidates, sets)
        else:
            open_, path = saved(open_cells(placed), "minhash-open")
            finished.append(path)
            if open_.isEmpty():
                break
            fresh = links_in_cells(blocked(open_, cell_rows).join(sets.hint("merge"), "node"))
        fresh, path = saved(fresh, f"minhash-links-{number}")
        finished.append(path)
        if not fresh.isEmpty():
            # What earlier rounds have joined is a star by now.
            roots = components(fresh if roots is None else fresh.unionByName(roots.toDF("v", "u")))
            number += 1
        else:
            # Where representatives link nothing, those of another round hardly would.
            number = max(rounds, number + 1)

    rooted = classes.select("name", "node", "first")
    rooted = rooted.join(roots, "node", "left") if roots is not None else rooted.withColumn("root", F.col("node"))
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("chosen"))
    named, _ = saved(rooted.join(smallest, "root").select("name", "chosen"), "minhash-named")
    discard(spark, classes_path, *finished)
    grouped = rows.where("size > 0").select("id", "tie", "size", "name").join(named, "name").drop("name")
    alone = rows.where("size = 0").select("id", "tie", "size", F.struct("id", "tie").alias("chosen"))
    return grouped.unionByName(alone).select(
        F.nullif("id", F.lit(LAST_ID)).alias("doc_id"),
        "tie",
        F.col("size").alias("n_shingles"),
        F.nullif("chosen.id", F.lit(LAST_ID)).alias("component_id"),
        (F.col("id") == F.col("chosen.id")).alias("kept"),
        ((F.col("id") == F.col("chosen.id")) & (F.col("tie") == F.col("chosen.tie"))).alias("chosen"),
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, all columns: that of the smallest doc_id."""
    chosen = near_duplicates(docs).where("chosen").select("doc_id", "tie").distinct()
    return one_row_each(docs, F.xxhash64("text").alias("tie"), chosen)
