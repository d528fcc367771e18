"""Large ids beside nulls, decisions that follow the method, and a dense chain of classifiers."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import as_multiset, brute_exact, docs, texts  # noqa: F401
from trailmart.llm import fuse, pieces, toxicity, warc
from trailmart.llm.common import prepare
from trailmart.llm.queries import QUERIES, model_path

LARGE = 1 << 62


def brute_archive(rows):
    """page_id, type and page referred to; rows of one payload and page_id are alike."""
    leaders, seen, found = {}, {}, []
    for i, html in rows:
        if len((html or "").encode()) >= 1000:
            leaders[html] = max(leaders.get(html, (False, 0)), (i is not None, i or 0))
    for i, html in rows:
        leader = leaders.get(html)
        response = leader is None or ((i is not None, i or 0) == leader and not seen.get(html))
        seen[html] = seen.get(html) or (leader is not None and response)
        found.append((i, "response" if response else "revisit", None if response or not leader[0] else leader[1]))
    return found


@pytest.mark.parametrize("with_null", [True, False])
def test_archives_keep_large_ids(spark, with_null):
    prepare(spark)
    long, other = "<p>" + "x" * 1200, "<q>" + "y" * 1500
    rows = [(LARGE + 12345 + k, long if k % 3 else other) for k in range(9)] + [(LARGE + 1, "short"), (-LARGE - 7, long)]
    rows += [(None, long), (None, "lone")] if with_null else []
    pages = spark.createDataFrame([(i, "http://u/", h) for i, h in rows], "page_id long, url string, html string").repartition(2)
    found = [(r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect()]
    assert as_multiset(found) == as_multiset(brute_archive(rows))


def test_exact_dedup_keeps_large_ids_beside_nulls(spark):
    prepare(spark)
    rows = [(LARGE + k, f"Text {k % 4}") for k in range(12)] + [(None, "text 1"), (None, "only null"), (None, None), (LARGE - 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for is_new in (None, F.lit(False), F.lit(True), F.col("doc_id").isNull(), F.coalesce(F.col("doc_id") % 2 == 1, F.lit(True))):
        assert as_multiset(fuse.exact_dedup(frame, is_new).collect()) == as_multiset(brute_exact(rows))


def test_copies_meet_only_through_the_filter(spark, monkeypatch):
    """Without hits a text of the batch is not joined to its copy in the snapshot."""
    prepare(spark)
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "doc_id long, text string")
    is_new = F.col("doc_id") >= 2
    assert {r.doc_id: r.keep_id for r in fuse.exact_dedup(frame, is_new).collect()} == {1: 3, 2: 3, 3: 3, 4: 4}
    monkeypatch.setattr(fuse, "screened", lambda incoming, filters: incoming.where("false"))
    with_none = fuse.exact_dedup(frame, is_new).groupBy("group_size").count().collect()
    # The two sides stay apart, so the digest they share is counted on both.
    assert {r["group_size"]: r["count"] for r in with_none} == {1: 4, 2: 3}


def test_map_marks_every_key_and_few_others(spark):
    prepare(spark)
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    words = fuse.map_of(keys)
    probe = spark.range(60_000).select("id", fuse.is_marked(F.xxhash64("id"), words.scalar()).alias("m"))
    found = {r.inside: r.n for r in probe.where("m").groupBy((F.col("id") < 20_000).alias("inside")).agg(F.count("*").alias("n")).collect()}
    assert found[True] == 20_000 and found.get(False, 0) < 400
    assert spark.range(10).where(fuse.is_marked(F.xxhash64("id"), fuse.map_of(keys.limit(0)).scalar())).count() == 0


def test_texts_are_encoded_once(spark, sf_dir):
    plan = QUERIES["op1_sentencepiece"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("there_and_back(") == plan.count("ArrowEvalPython") == 1


def test_tokenizer_columns_agree_with_the_round_trip(docs):  # noqa: F811
    tokenizer = pieces.Tokenizer(docs.sparkSession, model_path())
    apart = docs.select("doc_id", tokenizer.encode(F.col("text")).alias("ids")).withColumn("decoded", tokenizer.decode(F.col("ids")))
    both = pieces.documents_as_ids(docs, model_path())
    key = ("doc_id", F.col("ids").cast("string"), "decoded")
    assert as_multiset(apart.select(*key).collect()) == as_multiset(both.select(*key).collect())


# Toxicity: the chain once more, with dense rows and no shortcuts.


def dense_fit(x, extra, y, chosen):
    weights, bias = np.zeros(x.shape[1]), np.zeros(extra.shape[1])
    share = y[chosen].mean() if len(chosen) else 0.0
    clipped = min(max(share, 1e-4), 1 - 1e-4)
    bias[0] = np.log(clipped / (1 - clipped))
    if share in (0.0, 1.0):
        return weights, bias
    odds, variance = [], 0
    for k in (0, 1):
        own = chosen[y[chosen] == k]
        count = np.minimum(x[own].sum(axis=0), len(own))
        odds.append(np.log((count + 0.5) / (len(own) - count + 0.5)))
        variance = variance + 1 / (count + 0.5) + 1 / (len(own) - count + 0.5)
    telling = np.abs(odds[1] - odds[0]) >= toxicity.LEAST_Z * np.sqrt(variance)
    seen, seen_bias = np.full(x.shape[1], 1e-8), np.full(len(bias), 1e-8)
    rng = np.random.default_rng(toxicity.SEED)
    passes = max(toxicity.EPOCHS, -(-toxicity.LEAST_BATCHES * toxicity.BATCH_ROWS // len(chosen)))
    for _ in range(passes):
        order = rng.permutation(chosen)
        for low in range(0, len(order), toxicity.BATCH_ROWS):
            batch = order[low : low + toxicity.BATCH_ROWS]
            margin = x[batch] @ weights + extra[batch] @ bias
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]
            slope = (x[batch].T @ error / len(batch) + toxicity.RIDGE * weights) * telling
            slope_bias = extra[batch].T @ error / len(batch)
            seen += slope**2
            seen_bias += slope_bias**2
            weights -= toxicity.RATE * slope / np.sqrt(seen)
            bias -= toxicity.RATE * slope_bias / np.sqrt(seen_bias)
    return weights, bias


def dense_chain(slots, targets, folds):
    names = sorted({s for row in slots for s in row.tolist()})
    held = np.array([[name in row for name in names] for row in slots], float)
    common = held.sum(axis=0) >= toxicity.LEAST_ROWS
    x = np.column_stack([held[:, ~common].sum(axis=1), held[:, common]])
    extra, models, outs = np.ones((len(slots), 1)), [], []
    for k in range(targets.shape[1]):
        labelled = np.flatnonzero(~np.isnan(targets[:, k]))
        y = np.nan_to_num(targets[:, k])
        out = np.zeros(len(slots))
        for fold in range(toxicity.FOLDS):
            weights, bias = dense_fit(x, extra, y, labelled[folds[labelled] != fold])
            weights[0] = 0
            own = folds == fold
            out[own] = 1 / (1 + np.exp(-np.clip(x[own] @ weights + extra[own] @ bias, -30, 30)))
        weights, bias = dense_fit(x, extra, y, labelled)
        models.append((dict(zip(np.array(names)[common].tolist(), weights[1:], strict=True)), bias))
        outs.append(out)
        clipped = np.clip(out, 1e-4, 1 - 1e-4)
        extra = np.column_stack([extra, np.log(clipped / (1 - clipped))])
    return models, np.column_stack(outs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chain_equals_a_dense_one(seed):
    rng = np.random.default_rng(seed)
    slots, targets = [], []
    for i in range(240):
        poor, toxic = rng.random() < 0.3, rng.random() < 0.25
        row = set(rng.choice(40, rng.integers(0, 12), replace=False).tolist())
        row |= {100 + int(rng.integers(3))} if poor and rng.random() < 0.9 else set()
        row |= {200 + int(rng.integers(2))} if toxic and rng.random() < 0.9 else set()
        row |= {1000 + i} if i % 3 == 0 else set()
        slots.append(np.array(sorted(row), np.int32))
        targets.append([np.nan if i % 17 == 0 else poor, np.nan if i % 19 == 0 else toxic])
    targets, folds = np.array(targets, float), np.arange(240) % toxicity.FOLDS
    models, out = toxicity.fit_chain(slots, targets, folds)
    expected, expected_out = dense_chain(slots, targets, folds)
    assert np.allclose(out, expected_out, atol=1e-9)
    for (kept, weights, bias), (own, own_bias) in zip(models, expected, strict=True):
        assert kept.tolist() == list(own)
        assert np.allclose(weights, list(own.values()), atol=1e-6) and np.allclose(bias, own_bias, atol=1e-9)
    assert any(weights.any() for _, weights, _ in models)


def test_probabilities_of_documents_follow_the_models(spark, monkeypatch):
    """Every document's chain of probabilities from the trained models, word by word."""
    prepare(spark)
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(50)]
    rows = [(i, " ".join([*rng.choice(words, 20), *(["bad"] if i % 4 == 0 else [])]), "x", 1) for i in range(200)]
    frame = spark.createDataFrame([*rows, (900, None, None, None)], "doc_id long, text string, p_toxic string, rejected int")
    labels = spark.createDataFrame([(i, i % 3 and 1, int(i % 4 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    kept = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *given: kept.append(train(*given)) or kept[0])
    found = {r.doc_id: r for r in toxicity.toxicity(frame, labels).collect()}
    features = toxicity.Features()
    for i, text, *_ in [*rows, (900, None, None, None)]:
        extra = [1.0]
        for name, (slots, weights, bias) in zip(toxicity.CATEGORIES, kept[0], strict=True):
            own = dict(zip(slots, weights, strict=True))
            margin = sum(own.get(s, 0.0) for s in features.of(text).tolist()) + np.dot(extra, bias)
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            assert found[i][f"p_{name}"] == pytest.approx(p, abs=1e-5)
            q = min(max(p, 1e-4), 1 - 1e-4)
            extra.append(np.log(q / (1 - q)))
        assert found[i].rejected == (found[i][f"p_{toxicity.CATEGORIES[-1]}"] > toxicity.THRESHOLD)
    assert isinstance(found[0].p_toxic, float) and isinstance(found[0].rejected, bool)


def test_digest_of_the_archived_payload(spark):
    prepare(spark)
    pages = spark.createDataFrame([(LARGE, "u", "ä" * 700), (LARGE + 1, "u", "ä" * 700)], "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    assert found[LARGE].refers_to == LARGE + 1 and found[LARGE].payload is None
    assert found[LARGE].declared_digest == hashlib.sha1(("ä" * 700).encode()).hexdigest()
