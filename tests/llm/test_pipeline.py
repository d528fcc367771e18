"""The corpus pipeline, stage by stage, against plain Python on a small corpus."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from test_operators import brute_components, brute_exact, brute_fingerprint, words_of
from trailmart.llm import mixing
from trailmart.llm.queries import model_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(13)
    plain = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(700):
        words = [rnd.choice(plain) for _ in range(rnd.randint(30, 120))]
        toxic = i % 7 == 0
        if toxic:
            words[rnd.randrange(len(words))] = "venom" + rnd.choice("abcdef")
        elif i % 5 == 0 and i > 300:
            words = rows[rnd.randrange(1, 40) * 7 + 1][1].split()
            if i % 2:
                words[rnd.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", f"s{i % 3}" if i % 11 else None, 0))
        if i < 500:
            labels.append((i, 1, int(toxic)))
    rows += [(800, None, None, "s0", None), (801, "", "en", "s1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages(spark, corpus, tmp_path):
    folder, rows = corpus
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        result.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = docs.collect()

    clean = [(r.doc_id, r.text) for r in kept["toxicity"]]
    toxic = {i for i, text, *_ in rows if "venom" in (text or "")}
    assert not toxic & {i for i, _ in clean} and len(clean) >= 0.98 * (len(rows) - len(toxic))

    single = [(r.doc_id, r.text) for r in kept["exact dedup"]]
    assert Counter(i for i, _ in single) == Counter(i for i, _, _, stays, _ in brute_exact(clean) if stays)

    prints = brute_components([(i, brute_fingerprint(text)) for i, text in single])
    assert sorted(r.doc_id for r in kept["near dedup"]) == sorted({c for _, _, c in prints})

    near = spark.read.parquet(f"{tmp_path}/2")
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(near).collect()}
    expected = Counter({i: int(t / n + 0.5) for i, (t, n) in taken.items() if n})
    assert Counter(r.doc_id for r in kept["mixing"]) == +expected
    words, goals = defaultdict(int), {}
    for r in kept["mixing"]:
        words[r.source] += len(words_of(r.text))
    for r in mixing.source_targets(
        near.groupBy("source").agg(mixing.F.sum(mixing.word_count(mixing.F.col("text"))).alias("source_size"))
    ).collect():
        goals[r.source] = r.target
    assert all(abs(words[s] - goal) <= 0.05 * goal + 300 for s, goal in goals.items())

    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model_path())
    encoded = Counter()
    for r in kept["mixing"]:
        ids = library.encode(r.text or "", add_eos=True)
        sums = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids)))
        encoded[r.doc_id, len(ids), *sums] += 1
    assert Counter(map(tuple, kept["sentencepiece"])) == encoded


def test_run_equals_the_stages(spark, corpus):
    folder, _ = corpus
    first = Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert first == Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
