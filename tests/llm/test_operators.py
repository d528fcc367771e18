"""Operators against brute-force versions on small fixtures with awkward rows."""

from __future__ import annotations

import hashlib
import json
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

from trailmart.llm import chat, curves, fuse, mixing, pieces, sharding, simhash, substrings, toxicity, warc
from trailmart.llm.common import prepare, table
from trailmart.llm.components import components
from trailmart.llm.queries import QUERIES, model_path

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, size int, fp long"


def words_of(text):
    return (text or "").encode().split()


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def texts():
    """Ids and texts: nulls, empty and long ones, copies, near copies, repeated rows."""
    rnd = random.Random(7)
    vocabulary = ["the", "of", "Straße", "日本", "a", "é", "don't"] + [f"w{i}" for i in range(60)]
    made = []
    for i in range(150):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 4, 5, 30, 80, 150]))]
        if made and rnd.random() < 0.5:
            other = (rnd.choice(made)[1] or "").split()
            if rnd.random() < 0.5 and len(other) > 40:
                words = other[:]
                for _ in range(rnd.randint(0, 2)):
                    words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            else:
                at = rnd.randrange(len(words) + 1)
                words = words[:at] + other[: rnd.choice([34, 35, 36, 60])] + words[at:]
        if rnd.random() < 0.1:
            words += ["run"] * rnd.choice([10, 35, 37, 80])
        made.append((i, "".join(w + rnd.choice(SPACE) for w in words)))
    made += [(200, None), (201, ""), (202, " \n\t "), (203, None), (204, "x" * 5000), (205, "word " * 9000)]
    made += [(206, "UPPER lower"), (207, "upper LOWER"), (208, "É é"), (209, "é é"), (None, "no id"), (None, "no id at all")]
    return made + [made[3], made[3], (40, made[3][1]), made[40], (206, "UPPER lower")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    prepare(spark)
    rows = [
        (i, text, None if k % 9 == 0 else "en", None if k % 7 == 0 else f"s{k % 4}", 0, "x", 1, 2)
        for k, (i, text) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    prepare(spark)
    return spark.createDataFrame([], DOCS)


def as_multiset(rows):
    return Counter(map(tuple, rows))


# Pieces


def test_pieces_equal_the_library(docs, texts):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model_path())
    expected = []
    for i, text in texts:
        ids = library.encode(text or "", add_eos=True)
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    found = pieces.digests(pieces.documents_as_ids(docs, model_path())).collect()
    assert as_multiset(found) == as_multiset(expected)


def test_pieces_on_random_texts():
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_file=model_path()), pieces.Pieces(model_path())
    rnd = random.Random(3)
    alphabet = "abAB \n\t▁é日𝄞0019<>s/[]\x00ñthe  "
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    samples += ["a" * k for k in range(40)] + [" " * k for k in range(70)] + ["▁" * k + "\n" * (k % 3) for k in range(40)]
    samples += ["".join(library.id_to_piece(rnd.randrange(259, 32000)) for _ in range(12)) for _ in range(500)]
    encoded = pieces.encode_batch(pieces.WordIds(own), samples)
    assert [x.tolist() for x in encoded] == library.encode(samples, add_eos=True)
    assert [own.decode(x) for x in encoded] == [library.decode(x.tolist()) for x in encoded]
    for _ in range(2000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(300), rnd.randrange(130, 259)]) for _ in range(rnd.randint(0, 10))]
        assert own.decode(np.array(ids, np.int64)) == library.decode(ids)


# Nearest neighbours


def test_hilbert_keys_visit_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = grid[np.argsort(curves.hilbert_keys(grid, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def brute_nearest(rows, step, k):
    valid = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    width = Counter(len(v) for v in valid.values()).most_common(1)[0][0]
    valid = {i: v for i, v in valid.items() if len(v) == width}
    result = {}
    for i, v in valid.items():
        if i % step == 0:
            ranked = sorted((-float(v @ w), j) for j, w in valid.items() if j != i)
            result[i] = [j for _, j in ranked[:k]]
    return result


def test_nearest_is_exact_where_windows_cover_the_table(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.integers(-3, 4, 6)]) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(60)] + [(500, None), (501, [0.0] * 6), (502, [float("nan")] * 6)]
    rows += [(503, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (504, [1.0, 2.0]), (None, [1.0] * 6), (505, []), (506, [float("inf")] * 6), rows[40]]
    frame = spark.createDataFrame([(*row, 9) for row in rows], "vec_id long, embedding array<double>, rank int")
    found = defaultdict(list)
    for r in curves.nearest(frame, count=3, block_rows=64, share=1.0).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert dict(found) == brute_nearest(rows, 20, 20)
    assert curves.nearest(frame.where("vec_id < 0")).count() == 0


def test_nearest_recall_with_production_share(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    expected = brute_nearest(rows, 20, 20)
    # Small blocks, so that windows do not cover the table.
    found = defaultdict(set)
    for r in curves.nearest(vectors, block_rows=16).collect():
        found[r.query_id].add(r.vec_id)
    hits = sum(len(found[i] & set(best)) for i, best in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


# SimHash


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots_of(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(parent)}


def brute_components(prints):
    """Component id of each (doc_id, fingerprint)."""
    values = sorted({f for _, f in prints})
    roots = roots_of([(a, b) for a in values for b in values if bin(a ^ b).count("1") <= 4])
    least = {}
    for i, f in prints:
        if i is not None:
            least[roots[f]] = min(least.get(roots[f], i), i)
    return [(i, f, least.get(roots[f])) for i, f in prints]


@pytest.mark.parametrize("cell_rows", [4096, 3])
def test_simhash_components(docs, texts, cell_rows):
    prints = [(i, brute_fingerprint(text)) for i, text in texts]
    expected = [(i, f"{f:016x}", c) for i, f, c in brute_components(prints)]
    found = simhash.near_duplicates(docs, cell_rows=cell_rows)
    found = found.select("doc_id", simhash.hex_digits("fp"), "component_id").collect()
    assert as_multiset(found) == as_multiset(expected)


def test_simhash_links_of_random_fingerprints(spark):
    rnd = random.Random(11)
    values = [rnd.getrandbits(64) for _ in range(40)]
    for _ in range(400):
        value = rnd.choice(values)
        for bit in rnd.sample(range(64), rnd.randint(1, 5)):
            value ^= 1 << bit
        values.append(value)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in set(signed)], "fp long")
    links = simhash.links_in_cells(simhash.blocked(simhash.grid(prints), 50), 4).collect()
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") > 0 for a, b in links)
    own = roots_of([(a % 2**64, b % 2**64) for a, b in links] + [(v, v) for v in values])
    brute = roots_of([(a, b) for a in values for b in values if bin(a ^ b).count("1") <= 4])
    assert own == brute


def test_simhash_keeps_one_of_each_group(docs, nothing):
    kept = simhash.one_of_each_group(docs)
    groups = simhash.near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == groups.where("chosen").select("doc_id", "tie").distinct().count()
    # Every group that has an id at all has its smallest id among the rows that stay.
    assert {r.doc_id for r in kept.collect()} >= {r.component_id for r in groups.collect()}
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each_group(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7)]
    links += [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    rnd.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    expected = roots_of(links)
    assert found == {x: r for x, r in expected.items() if any(x in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_that_are_stars_cost_one_table(spark, monkeypatch):
    """Stars are known as such when neighbours are counted; other rounds never add rows."""
    module = sys.modules[components.__module__]
    stored, save = [], module.saved

    def counting(df, label, *given):
        table, path = save(df, label, *given)
        stored.append((label, table.count()))
        return table, path

    monkeypatch.setattr(module, "saved", counting)
    stars = [(10, 11 + i) for i in range(20)] + [(51 + i, 50) for i in range(20)] + [(51, 50), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(stars, "u long, v long")).collect()}
    assert found == {x: r for x, r in roots_of(stars).items() if x != 7} and stored == [("components-ends", 42)]
    stored.clear()
    rnd = random.Random(3)
    links = [(900 - i, 901 - i) for i in range(60)] + [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] * 2
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for link in links if link[0] != link[1] for x in link}
    assert found == {x: r for x, r in roots_of(links).items() if x in linked}
    assert all(n <= len(links) for label, n in stored if label == "components")


# Toxicity


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(1)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(plain) for _ in range(40)]
        toxic, poor = i % 6 == 0, i % 5 == 0
        if toxic:
            words[rnd.randrange(40)] = "venom" + rnd.choice(["a", "b", "cd", "xyz"])
        if poor:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words)))
        if i < 600:
            labels.append((i, int(not poor), int(toxic)))
    labels += [(5, None, None), (None, 1, 1), (0, 1, 1)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "w1 w2")], "doc_id long, text string")
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.rejected for r in toxicity.toxicity(docs, given).collect() if r.doc_id is not None}
    assert len(found) == 902
    held = range(600, 900)
    caught = [found[i] for i in held if i % 6 == 0]
    assert sum(caught) >= 0.95 * len(caught)
    assert not any(found[i] for i in held if i % 6)
    assert not found[1000] and not found[1001]


def test_toxicity_without_labels_or_documents(docs, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, none).where("rejected").count() == 0
    assert toxicity.not_toxic(docs, none).columns == docs.columns
    assert toxicity.not_toxic(nothing, none).count() == 0


def test_later_categories_use_out_of_fold_probabilities():
    # The second category is the first one again: only its probability can tell, as no slot repeats.
    rnd = np.random.default_rng(4)
    first = rnd.random(600) < 0.5
    slots = [np.array([5 if y else 6], np.int32) for y in first]
    models, out = toxicity.fit_chain(slots, np.column_stack([first, first]).astype(float), np.arange(600) % 3)
    assert models[1][2][1] > 0
    assert ((out[:, 1] > 0.5) == first).all()


# Substrings


def brute_substrings(texts):
    listed = [words_of(text) for _, text in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in listed for i in range(len(w) - 34))
    rows = []
    for (i, _), w in zip(texts, listed, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        rows.append((i, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return rows


def test_substrings(docs, texts, nothing):
    expected = brute_substrings(texts)
    assert sum(r[2] for r in expected) > 1000
    assert as_multiset(substrings.dedup_substrings(docs).collect()) == as_multiset(expected)
    assert substrings.dedup_substrings(nothing).count() == 0


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(8)
    listed = []
    for _ in range(120):
        words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(0, 90))]
        if listed:
            words += rnd.choice(listed)[: rnd.randint(30, 60)] + [b"a"] * rnd.randint(0, 40)
        listed.append(words)
    names = substrings.WordNames().of([w for one in listed for w in one])[:, 0]
    seen = {}
    covered = 0
    rows = substrings.anchors(names, np.array([len(w) for w in listed]))
    for name, text, first, last, _ in zip(*(x.tolist() for x in rows), strict=True):
        for start in range(first, last + 1):
            covered += 1
            assert seen.setdefault(tuple(listed[text][start : start + 35]), name) == name
    assert covered == sum(max(0, len(w) - 34) for w in listed)


# Exact copies


def brute_exact(texts):
    groups = defaultdict(list)
    for i, text in texts:
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        groups[lowered].append(i)
    rows = []
    for lowered, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            rows.append((i, keep, len(ids), kept, sha(lowered)))
    return rows


@pytest.mark.parametrize("bucket_rows", [20_000, 10])
def test_exact_dedup(docs, texts, nothing, bucket_rows):
    found = fuse.exact_dedup(docs, bucket_rows=bucket_rows).collect()
    assert as_multiset(found) == as_multiset(brute_exact(texts))
    assert fuse.exact_dedup(nothing).count() == 0


def test_exact_dedup_filters_rows(docs, texts, nothing):
    kept = fuse.without_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in brute_exact(texts))
    assert fuse.without_copies(nothing).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 10, 1000, 30_000])
def test_fuse_filter_has_no_false_negatives(count):
    rng = np.random.default_rng(count)
    keys = rng.integers(0, 2**63, count, dtype=np.uint64)
    made = fuse.build_filter(np.concatenate([keys, keys[:1]]))
    assert made.holds(keys).all()
    others = rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)
    assert made.holds(others).mean() < 0.001


# Shards


def test_shards_fit_and_split_only_where_needed(docs, texts, nothing):
    limit = 4000
    rows = sharding.assign_shards(docs, limit=limit).collect()
    assert len(rows) == len(texts)
    sizes, depths, counts = Counter(), {}, Counter()
    for r in rows:
        sizes[r.shard] += r.bytes
        counts[r.shard] += 1
        depths[r.shard] = r.depth
    assert all(size <= limit or counts[shard] == 1 for shard, size in sizes.items())
    prefixes = sorted(shard.split("-")[1] for shard in sizes)
    assert not any(b.startswith(a) and a != b for a, b in zip(prefixes, prefixes[1:], strict=False))
    # Whatever was split was too large.
    for shard, depth in depths.items():
        if depth:
            parent = shard.split("-")[1][: depth - 1]
            assert sum(n for s, n in sizes.items() if s.split("-")[1].startswith(parent)) > limit
    assert sharding.assign_shards(nothing).count() == 0


def test_equal_keys_get_overflow_pages(spark):
    rows = spark.createDataFrame([(None, "x" * n) for n in [300] * 50 + [900] * 5 + [2000]], "doc_id long, text string")
    sizes, counts = Counter(), Counter()
    for r in sharding.assign_shards(rows, limit=1000).collect():
        sizes[r.shard] += r.bytes
        counts[r.shard] += 1
    assert sum(counts.values()) == 56
    assert all(size <= 1000 or counts[s] == 1 for s, size in sizes.items())


def test_shards_are_written(docs, spark, tmp_path, texts):
    assigned = sharding.write_shards(docs, str(tmp_path / "shards"), limit=4000)
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert written.count() == len(texts)
    assert written.select("shard").distinct().count() == assigned.select("shard").distinct().count()


# Mixing


def test_targets_against_repeated_sharing(spark):
    sizes = {"a": 10, "b": 0, "c": 400, "d": 50, "e": 1000, None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    names = sorted(s for s in sizes if s is not None) + [None]
    weight = {name: (5, 2, 1)[k % 3] for k, name in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[n] for n in open_)
        share = {n: left * weight[n] / total for n in open_}
        left = 0.0
        for n in list(open_):
            target[n] += share[n]
            if target[n] >= 3 * sizes[n]:
                left += target[n] - 3 * sizes[n]
                target[n] = 3.0 * sizes[n]
                open_.discard(n)
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(target)


def test_apportionment_takes_the_highest_quotients():
    rnd = random.Random(9)
    for _ in range(200):
        targets = [rnd.choice([0.0, rnd.random() * 100]) for _ in range(rnd.randint(1, 8))]
        limits = [rnd.randint(0, 60) for _ in targets]
        seats = rnd.randint(0, 150)
        expected = [0] * len(targets)
        for _ in range(seats):
            open_ = [(-t / (2 * q + 1), i) for i, (t, q, m) in enumerate(zip(targets, expected, limits, strict=True)) if q < m and t > 0]
            if open_:
                expected[min(open_)[1]] += 1
        assert mixing.apportion(targets, limits, seats) == expected


@pytest.mark.parametrize("shard_words", [4_000_000, 3000])
def test_mix(docs, texts, nothing, shard_words):
    rows = mixing.mix(docs, block_words=8, shard_words=shard_words).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len(words_of(t))) for i, t in texts)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix(docs.repartition(3), block_words=8, shard_words=shard_words).collect()
    assert as_multiset(rows) == as_multiset(again)
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        taken[r.target, r.source_size] += r.taken
    for (goal, _), got in taken.items():
        assert abs(got - goal) <= 0.05 * goal + 100
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(nothing).count() == 0


# Chats


def test_layouts_agree(spark):
    pairs = [("hi </s>", "[INST] \\e; ok\n<|end|>\n"), ("", None), (None, "x")]
    turns = [(k, n, r, t) for k, pair in enumerate(pairs) for n, (r, t) in enumerate(zip(("user", "assistant"), pair, strict=True))]
    frames = [
        spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"),
        spark.createDataFrame([(k, [("user", a), ("assistant", b)], 1) for k, (a, b) in enumerate(pairs)],
                              "conv_id long, messages array<struct<role string, content string>>, extra int"),
        spark.createDataFrame([(k, [("human", a), ("gpt", b)]) for k, (a, b) in enumerate(pairs)],
                              "conv_id long, conversations array<struct<`from` string, value string>>"),
        spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "conv_id long, prompt string, completion string"),
        spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "conv_id long, instruction string, output string"),
    ]
    read = [
        sorted(map(json.dumps, (r.asDict(True) for r in chat.read_chats(chat.format_chats(chat.canonical_turns(f))).collect())))
        for f in frames
    ]
    assert all(r == read[0] for r in read)
    first = [json.loads(r) for r in read[0]]
    for r in first:
        a, b = pairs[r["conv_id"]]
        assert [t["text"] for t in r["turns"]] == [a or "", b or ""]
        assert r["loss_text"] == (b or "")
        assert not any(c in r["formatted"].replace(chat.TURN_OPEN, "").replace(chat.TURN_CLOSE, "") for c in chat.CONTROL)
    with_input = spark.createDataFrame([(1, "do", "this", "ok")], "conv_id long, instruction string, input string, output string")
    assert [r.text for r in chat.canonical_turns(with_input).orderBy("part").collect()] == ["do\n\nthis", "ok"]
    with pytest.raises(ValueError):
        chat.layout_of(spark.createDataFrame([(1, 2)], "a int, b int").schema)


def test_chats_round_trip_awkward_turns(spark):
    rnd = random.Random(6)
    bits = [*chat.CONTROL, "\\", "\\e;", "\\1;", "\n", "<|", "|>", "é", "日", "a", ";"]
    rows = [
        (rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0, 1, 2]), rnd.choice([None, "user", "assistant", "a\nb<s>"]),
         rnd.choice([None, "".join(rnd.choice(bits) for _ in range(12))]))
        for _ in range(80)
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, start string, output int")
    groups = defaultdict(list)
    for i, turn, role, text in rows:
        groups[i].append((turn is not None, turn or 0, role or "", text or ""))
    found = chat.read_chats(chat.format_chats(chat.canonical_turns(frame))).collect()
    assert len(found) == len(groups)
    for r in found:
        expected = [(role, text) for _, _, role, text in sorted(groups[r.conv_id])]
        assert [tuple(t) for t in r.turns] == expected
        assert r.loss_text == "".join(text for role, text in expected if role == "assistant")
        joined = "".join(r.formatted[s.start : s.start + s.length] for s in r.loss_spans)
        assert len(joined) == sum(s.length for s in r.loss_spans)
    empty = chat.canonical_turns(frame.where("false"))
    assert chat.read_chats(chat.format_chats(empty)).count() == 0


def test_chat_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op9_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))


# Archives


def test_archives(spark):
    long = "<p>" + "ä" * 800
    rows = [(1, "http://a/", long), (5, "http://b/é x", long), (3, None, long), (7, "u", None), (8, "u", ""), (9, "u", "short"),
            (10, "u", "short"), (None, "n", long + "!"), (None, "n", long + "!"), (11, "u", "W" * 3_000_000), (12, "u", long + "?"), (12, "u", long + "?")]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, row int").repartition(3)
    found = warc.archive_pages(pages).collect()
    assert len(found) == len(rows)
    by_page = defaultdict(list)
    for r in found:
        by_page[r.page_id].append(r)
    for i, _, html in rows:
        data = (html or "").encode()
        for r in by_page[i]:
            if r.page_id is not None:
                assert (r.declared_digest, r.declared_bytes) == (hashlib.sha1(data).hexdigest(), len(data))
                assert r.payload is None or bytes(r.payload) == data
    assert [by_page[i][0].refers_to for i in (1, 3, 5)] == [5, 5, None]
    assert sorted(r.record_type for r in by_page[12]) == ["response", "revisit"]
    assert sorted(r.record_type for r in by_page[None]) == ["response", "revisit"]
    assert all(r.record_type == "response" for i in (7, 8, 9, 10, 11) for r in by_page[i])
    assert len({r.record_id for r in found}) == len(rows)
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_normaliser_reads_any_member_layout():
    import io
    import zlib

    records = [warc.record(k, k, "u", b"x" * (k * 50_000), hashlib.sha1(b"x" * (k * 50_000)).hexdigest(), None, None) for k in range(6)]

    def member(data):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()

    for archive in (member(b"".join(records)), b"".join(map(member, records)), member(b"".join(records[:3])) + member(b"".join(records[3:]))):
        assert [data for _, data in warc.records_of(warc.inflated(io.BytesIO(archive)))] == records
    with pytest.raises(ValueError):
        list(warc.records_of(warc.inflated(io.BytesIO(member(b"".join(records)[:-10])))))
