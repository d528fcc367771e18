"""MinHash groups, ranked search and token alignment against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from test_operators import DOCS, as_multiset, docs, nothing, texts, words_of  # noqa: F401
from trailmart.llm import alignment, lexical, minhash
from trailmart.llm.common import prepare
from trailmart.llm.queries import BYTE_MODEL, model_path

# MinHash


def brute_shingles(text):
    words = [w.lower() for w in words_of(text)]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([b" ".join(words)])
    return frozenset(b" ".join(words[k : k + 5]) for k in range(len(words) - 4))


def brute_groups(rows):
    """doc_id, size of the set, smallest id reachable, whether the row has it."""
    sets = sorted({brute_shingles(text) for _, text in rows}, key=len)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            owners[x].append(k)
    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in owners[x] if j < k)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                parent[root(j)] = root(k)
    number = {s: k for k, s in enumerate(sets)}
    least = {}
    for i, text in rows:
        s = brute_shingles(text)
        if s and i is not None:
            r = root(number[s])
            least[r] = min(i, least.get(r, i))
    found = []
    for i, text in rows:
        s = brute_shingles(text)
        c = least.get(root(number[s])) if s else i
        found.append((i, len(s), c, i == c))
    return found


def grouped(docs, **how):
    return minhash.near_duplicates(docs, **how).select("doc_id", "n_shingles", "component_id", "kept").collect()


def test_minhash_groups(docs, texts):  # noqa: F811
    assert as_multiset(grouped(docs)) == as_multiset(brute_groups(texts))


@pytest.mark.parametrize("how", [{"cell_rows": 3, "rounds": 0}, {"cell_rows": 8, "rounds": 2}])
def test_minhash_chains_and_templates(spark, how):
    """Chains of small edits, a crowd of variants of one text, and texts that share half of their words."""
    prepare(spark)
    rnd = random.Random(5)
    base = [f"b{k}" for k in range(300)]
    rows, words = [], [f"c{k}" for k in range(200)]
    for i in range(30):
        words = words[:]
        words[rnd.randrange(200)] = f"x{i}"
        rows.append((1000 - i, " ".join(words)))
    for i in range(60):
        copy = base[:]
        for k in range(i % 4):
            copy[rnd.randrange(300)] = f"y{i}-{k}"
        rows.append((2000 + i, " ".join(copy)))
    rows += [(3000 + i, " ".join(base[:150] + [f"z{i}-{k}" for k in range(150)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)  # noqa: F811
    assert as_multiset(grouped(docs, **how)) == as_multiset(brute_groups(rows))


def test_a_crowd_of_variants_costs_a_few_pairs_each(spark, monkeypatch):
    """Variants of one text meet in all bands; candidates stay in proportion to them."""
    prepare(spark)
    rnd = random.Random(9)
    base, rows = [f"b{k}" for k in range(200)], []
    for i in range(1500):
        words = base[:]
        for _ in range(rnd.choice([1, 1, 2])):
            words[rnd.randrange(200)] = f"v{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    counts, save = [], minhash.saved

    def counting(df, label, *given):
        table, path = save(df, label, *given)
        if "candidates" in label:
            counts.append(table.count())
        return table, path

    monkeypatch.setattr(minhash, "saved", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)  # noqa: F811
    found = grouped(docs, cell_rows=256)
    assert as_multiset(found) == as_multiset(brute_groups(rows))
    assert 0 < sum(counts) <= 10 * len(rows)


def test_a_crowd_just_below_the_threshold_makes_no_pairs(spark, monkeypatch):
    """Variants that survive verification in pairs but are not similar enough are decided where they meet."""
    prepare(spark)
    rnd = random.Random(4)
    base, rows = [f"b{k}" for k in range(200)], []
    for i in range(200):
        words = base[:]
        for k in rnd.sample(range(5, 190, 10), 2):
            words[k] = f"v{i}-{k}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rows[i][1].split()[:-3])) for i in range(0, 200, 20)]
    counts, save = {}, minhash.saved

    def counting(df, label, *given):
        table, path = save(df, label, *given)
        counts[label] = table.count()
        return table, path

    monkeypatch.setattr(minhash, "saved", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)  # noqa: F811
    assert as_multiset(grouped(docs, cell_rows=64)) == as_multiset(brute_groups(rows))
    pairs = sum(n for label, n in counts.items() if "candidates" in label or "links" in label)
    assert pairs <= 10 * len(rows)


def test_candidates_move_once_after_they_are_dealt(spark, monkeypatch):
    """A round deals members by cell, then by node, and moves its pairs once more to their representatives."""
    prepare(spark)
    base = [f"b{k}" for k in range(200)]
    rows = [(i, " ".join(base[:k] + [f"v{i}"] + base[k + 1 :])) for i, k in enumerate(range(5, 195, 10))]
    plans, save = {}, minhash.saved

    def noting(df, label, *given):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return save(df, label, *given)

    monkeypatch.setattr(minhash, "saved", noting)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = grouped(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))  # noqa: F811
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert as_multiset(found) == as_multiset(brute_groups(rows))
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#", plans["minhash-candidates-0"])
    # Two sides by cell, two by the member's node, two by the representative.
    assert len(dealt) == 6 and dealt.count("cell") == dealt.count("v") == 2
    # All are linked in the first round; the next one finds nothing, and no round stores its members anew.
    assert not [label for label in plans if label.startswith("minhash-open-")]


def test_exact_comparison_of_two_sets():
    numbers = np.arange(100, dtype=np.uint64)
    assert minhash.similar(numbers, numbers[:85]) and minhash.similar(numbers[15:], numbers)
    assert not minhash.similar(numbers, numbers[:84]) and not minhash.similar(numbers[:50], numbers[50:])
    assert minhash.similar(np.append(numbers[:92], np.uint64(200)), numbers[:93])
    assert not minhash.similar(np.append(numbers[:9], np.uint64(200)), numbers[:10])


def test_minhash_at_the_threshold(spark):
    """Sets of 85 of 100 shingles are linked, of 84 of 100 are not."""
    prepare(spark)
    words = [f"w{k}" for k in range(104)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:89])), (3, " ".join(words[16:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")  # noqa: F811
    assert as_multiset(grouped(docs)) == {(1, 100, 1, True): 1, (2, 85, 1, False): 1, (3, 84, 3, True): 1}


def test_places_are_by_agreement_within_each_list():
    rnd = np.random.default_rng(2)
    owner, of, agreed = rnd.integers(0, 5, 400), rnd.integers(0, 3, 400), rnd.integers(0, 300, 400)
    places = minhash.places_in_lists(owner, of, agreed)
    for key in {(a, b) for a, b in zip(owner.tolist(), of.tolist(), strict=True)}:
        mine = (owner == key[0]) & (of == key[1])
        assert sorted(places[mine].tolist()) == list(range(mine.sum()))
        assert (np.diff(agreed[mine][np.argsort(places[mine])]) <= 0).all()
    assert len(minhash.places_in_lists(*[np.zeros(0, np.int64)] * 3)) == 0


def test_minhash_of_nothing(spark, nothing):  # noqa: F811
    assert grouped(nothing) == []


def test_posterior_bounds():
    """The tail of the posterior by numerical integration, on either side of each bound."""
    needed = minhash.least_agreement()
    t = 0.85 + 0.15 / 256
    grid = np.linspace(0, 1, 200_001)[1:-1]
    for number, m in enumerate(needed[:4], start=1):
        n = number * minhash.BATCH

        def tail(m, n=n):
            density = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - n * math.log(0.5))
            return density[grid >= t].sum() / density.sum()

        assert tail(int(m)) >= minhash.MISS * 0.9 and tail(int(m) - 1) < minhash.MISS * 1.1


def test_pairs_above_the_threshold_survive():
    """Signatures of pairs at the threshold are ruled out about as rarely as chosen."""
    factors, offsets = minhash.permutations()
    rnd = np.random.default_rng(1)
    left, right = [], []
    for _ in range(300):
        shared = rnd.integers(0, 1 << 63, 850, np.uint64)
        own = rnd.integers(0, 1 << 63, 150, np.uint64)
        for side, part in ((left, own[:75]), (right, own[75:])):
            side.append(minhash.signature(np.concatenate([shared, part]), factors, offsets).view(np.uint8))
    left, right = np.array(left), np.array(right)
    assert len(minhash.may_be_similar(left, right, minhash.least_agreement())[0]) == 300
    agreed = (left == right).mean()
    assert abs(agreed - 0.85) < 0.01
    assert len(minhash.may_be_similar(left[:-1], right[1:], minhash.least_agreement())[0]) == 0


# Ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(rows, items, top=10):
    counted = [(i, Counter(brute_terms(text))) for i, text in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    holding = Counter(term for _, c, _ in counted for term in c)
    documents, words = len(counted), sum(n for *_, n in counted)
    found = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * documents) // words
            score = 0
            for term in set(brute_terms(text)):
                if term in c:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[term] + 1)))
                    score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score:
                scores.append((-score, math.inf if i is None else i, i))
        found += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:top], 1)]
    return found


ITEMS = [
    (1, "the of W3 w4 straße 日本"), (2, "don't word"), (3, ""), (4, None), (5, "nowhere to be found"), (6, "the the THE"),
    (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (7, "run, run! É"), (7, "upper lower x " + " ".join(f"w{k}" for k in range(60))),
]


@pytest.mark.parametrize("block", [lexical.QUERY_TERMS, 10])
def test_search(spark, docs, texts, block):  # noqa: F811
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id long, text string, n int, score int")
    found = lexical.ranked_search(docs, items, block_terms=block).collect()
    assert as_multiset(found) == as_multiset(brute_search(texts, ITEMS))


def test_search_of_nothing(spark, docs, nothing):  # noqa: F811
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.ranked_search(nothing, items).collect() == []
    assert lexical.ranked_search(docs, items.limit(0)).collect() == []


def test_intervals_give_the_best():
    """Random lists with many equal impacts, all numbers of results; reads leave no trace."""
    rnd = np.random.default_rng(4)
    for round_ in range(300):
        size, vocabulary = int(rnd.integers(1, 60)), int(rnd.integers(1, 8))
        held = rnd.random((vocabulary, size)) < rnd.random()
        values = rnd.integers(0, [3, 20, 10**9][round_ % 3], (vocabulary, size)) * held
        term, doc = np.nonzero(held)
        lists = lexical.sorted_lists(term, doc, values[term, doc], vocabulary)
        ids = rnd.permutation(size)
        asked = np.flatnonzero(rnd.random(vocabulary) < 0.8)
        zeros = np.zeros(size, np.int64)
        scores = values[asked].sum(axis=0)
        expected = sorted((-s, i, d) for d, (s, i) in enumerate(zip(scores.tolist(), ids.tolist(), strict=True)) if s)
        top = int(rnd.integers(1, 12))
        assert lexical.best_by_intervals(lists, asked, ids, zeros, top) == [(d, -s) for s, _, d in expected[:top]]
        assert not zeros.any()


# Alignment


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(model_path(BYTE_MODEL))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=model_path())
    letters = alignment.byte_letters()

    def spelt(piece):
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    made = []
    for i, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text or "") if text else []
        a_bytes = [bytes(letters[c] for c in first.id_to_token(x)) for x in a]
        b_bytes = [spelt(second.id_to_piece(x)) for x in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            made.append((i, [], [], [], []))
            continue
        spans = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(x) for x in parts]).tolist()
            spans.append([(x, e - len(p), e) for x, p, e in zip(ids, parts, ends, strict=True)])
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = [
            "|".join(",".join(str(x) for x, _, e in side if low < e <= high) for side in spans)
            for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        links = [(x, y) for x, s, e in spans[0] for y, t, u in spans[1] if s < u and t < e]
        made.append((i, a, b, groups, links))
    counts = Counter(pair for *_, links in made for pair in set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [
        (
            i, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, a, b, groups, links in made
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    (500, "<|endoftext|> and </s> <s> stay text"), (501, "under▁score"), (502, " "), (503, "a"), (504, "\x00\x07 tab\t"),
    (505, "naïve 日本語 𝄞 emoji 🙂🙂"), (506, "aaaa aaaa"), (507, "aaaa aaaa"), (508, "  two  spaces \n\n lines"), (None, "aaaa"),
]


@pytest.mark.parametrize("head", [alignment.HEAD_PAIRS, 3, 0])
def test_alignment(spark, texts, head):  # noqa: F811
    prepare(spark)
    rows = [(i, text and text[:2000]) for i, text in texts[:60] + texts[-20:]] + ODD
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n_a int, pairs string").repartition(3)
    found = alignment.cross_tokenizer(frame, model_path(BYTE_MODEL), model_path(), head).select(*COLUMNS).collect()
    assert as_multiset(found) == as_multiset(brute_alignment(rows))


def test_alignment_of_nothing(nothing):  # noqa: F811
    assert alignment.cross_tokenizer(nothing, model_path(BYTE_MODEL), model_path()).collect() == []
