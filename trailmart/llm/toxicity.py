"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each is a logistic regression on the presence
of hashed words and word beginnings that also gets the probabilities of the categories
before it; for training, those come from models that have not seen the row (out of fold).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Order of the chain: later categories see the probabilities of earlier ones.
CATEGORIES = ("low_quality", "toxic")
#: Labelled rows the models are fitted on at most; the sample is drawn by hash.
FIT_ROWS = 12_000
FOLDS = 3
FEATURE_BITS = 20
#: Beginnings of words that are features besides the words: inflected forms share them.
STEMS = (4, 5)
#: Sampled rows that must have a feature for it to get a weight.
LEAST_ROWS = 3
#: Standard errors by which the log odds of a feature must differ between the classes.
LEAST_Z = 3.5
#: Ends of words that are features too: noise often sits there.
ENDS = (3,)
EPOCHS = 8
#: Small samples are gone over more often, until this many batches have been seen.
LEAST_BATCHES = 1500
BATCH_ROWS = 128
RATE = 0.1
RIDGE = 1e-5
SEED = 42
THRESHOLD = 0.4
CACHE_WORDS = 200_000


class Features:
    """Hashed presence features of a text; the slots of each word are remembered.

    With ``wanted`` (one flag per slot) other slots are left out.
    """

    def __init__(self, bits: int = FEATURE_BITS, wanted: np.ndarray | None = None):
        self.size = 1 << bits
        self.wanted = wanted
        self.known: dict[str, tuple[int, ...]] = {}

    def slots(self, word: str) -> tuple[int, ...]:
        from xxhash import xxh3_64_intdigest

        names = {word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)}
        names.update(f"*{word[-n:]}" for n in ENDS if len(word) > n)
        found = (xxh3_64_intdigest(name) % self.size for name in names)
        return tuple(found) if self.wanted is None else tuple(slot for slot in found if self.wanted[slot])

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct slots of the words of the whole text, in lower case."""
        words = set((text or "").lower().split())
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for word in words.difference(self.known):
            self.known[word] = self.slots(word)
        found = {slot for word in words for slot in self.known[word]}
        return np.sort(np.fromiter(found, np.int32, len(found)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Rows:
    """Sparse rows: the slots of all rows one after the other, where each row starts, dense columns."""

    slots: np.ndarray
    starts: np.ndarray
    dense: np.ndarray

    def only(self, wanted: np.ndarray) -> Rows:
        """The same rows with the wanted slots alone, numbered anew."""
        keep = wanted[self.slots]
        starts = np.concatenate([[0], np.cumsum(keep)])[self.starts]
        return Rows((np.cumsum(wanted) - 1)[self.slots[keep]], starts, self.dense)

    def part(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots, row number within the part, and dense columns of the chosen rows."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[chosen] - (ends - sizes), sizes)
        return self.slots[index], np.repeat(np.arange(len(chosen)), sizes), self.dense[chosen]


def fit(rows: Rows, target: np.ndarray, chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of slots and dense columns from the chosen rows.

    Logistic regression in small batches; each weight's step shrinks with the gradients it
    has seen. Rows of one class only, or none, give the (clipped) share of that class.
    """
    weights, extra = np.zeros(size), np.zeros(rows.dense.shape[1])
    share = float(target[chosen].mean()) if len(chosen) else 0.0
    extra[0] = logit(np.array(share))
    if share in (0.0, 1.0):
        return weights, extra
    telling = telling_features(rows, target, chosen, size)
    inner = rows.only(telling)
    own = np.zeros(telling.sum())
    seen, seen_extra = np.full(len(own), 1e-8), np.full(len(extra), 1e-8)
    rng = np.random.default_rng(SEED)
    for _ in range(max(EPOCHS, -(-LEAST_BATCHES * BATCH_ROWS // len(chosen)))):
        order = rng.permutation(chosen)
        for low in range(0, len(order), BATCH_ROWS):
            batch = order[low : low + BATCH_ROWS]
            slots, owner, dense = inner.part(batch)
            margin = np.bincount(owner, own[slots], len(batch)) + dense @ extra
            error = sigmoid(margin) - target[batch]
            slope = np.bincount(slots, error[owner], len(own)) / len(batch) + RIDGE * own
            slope_extra = dense.T @ error / len(batch)
            seen += slope**2
            seen_extra += slope_extra**2
            own -= RATE * slope / np.sqrt(seen)
            extra -= RATE * slope_extra / np.sqrt(seen_extra)
    weights[telling] = own
    return weights, extra


def telling_features(rows: Rows, target: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    """Features whose log odds differ between the classes by enough standard errors."""
    with_it, without = [], []
    for k in (0, 1):
        own = chosen[target[chosen] == k]
        count = np.minimum(np.bincount(rows.part(own)[0], minlength=size), len(own))
        with_it.append(count + 0.5)
        without.append(len(own) - count + 0.5)
    odds = np.log(with_it[1] / without[1]) - np.log(with_it[0] / without[0])
    error = np.sqrt(sum(1 / x for x in (*with_it, *without)))
    return np.abs(odds) >= LEAST_Z * error


def predict(rows: Rows, chosen: np.ndarray, weights: np.ndarray, extra: np.ndarray) -> np.ndarray:
    slots, owner, dense = rows.part(chosen)
    return sigmoid(np.bincount(owner, weights[slots], len(chosen)) + dense @ extra)


def fit_chain(slots: list[np.ndarray], targets: np.ndarray, folds: np.ndarray):
    """One model per column of ``targets`` (nan: not labelled), and out-of-fold probabilities."""
    flat = np.concatenate([*slots, np.zeros(0, np.int32)])
    starts = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int64)
    # Rare features get no weight; the others are numbered anew.
    found, index, counts = np.unique(flat, return_inverse=True, return_counts=True)
    common = counts >= LEAST_ROWS
    number = np.where(common, np.cumsum(common), 0)
    kept = found[common]
    size = len(kept) + 1
    inner = number[index]
    dense = np.ones((len(slots), 1))
    models, outs = [], []
    for k in range(targets.shape[1]):
        rows = Rows(inner, starts, dense)
        labelled = np.flatnonzero(~np.isnan(targets[:, k]))
        target = np.nan_to_num(targets[:, k])
        out = np.zeros(len(slots))
        for fold in range(FOLDS):
            held = np.flatnonzero(folds == fold)
            model = fit(rows, target, labelled[folds[labelled] != fold], size)
            out[held] = predict(rows, held, *_silent(model))
        weights, extra = _silent(fit(rows, target, labelled, size))
        models.append((kept, weights[1:].astype(np.float32), extra))
        outs.append(out)
        dense = np.column_stack([dense, logit(out)])
    return models, np.column_stack(outs)


def _silent(model: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The model without a weight for the slot that all rare features share."""
    weights, extra = model
    weights[0] = 0
    return weights, extra


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """Slots and labels of at most ``fit_rows`` labelled documents, drawn by hash.

    Several labels of a document count as one, the worst. The sample of labels is at most
    ``fit_rows`` rows, which is why it may be broadcast to the documents.
    """
    merged = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(1 - F.col("quality")).cast("double").alias("low_quality"), F.max("toxic").cast("double").alias("toxic")
    )
    merged = merged.withColumn("draw", F.xxhash64(F.lit(SEED), "doc_id"))
    drawn = merged.orderBy("draw", "doc_id").limit(fit_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    # One row per label, however often its doc_id repeats; combined map-side.
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text")))
    texts = joined.groupBy("doc_id", "draw", *CATEGORIES).agg(one.alias("text"))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def slots(column: pa.Array) -> pa.Array:
        known = Features()
        return pa.array([known.of(text) for text in column.to_pylist()], pa.list_(pa.int32()))

    return texts.select("draw", *CATEGORIES, slots("text").alias("slots"))


MODEL_SCHEMA = "category int, slots array<int>, weights array<float>, extra array<double>"


def train(sample: DataFrame, fit_rows: int = FIT_ROWS) -> list[tuple]:
    """The models of the chain; the sample is bounded, so one task fits them."""

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(size=rows["slots"].map(len)).sort_values(["draw", "size"], kind="stable").iloc[:fit_rows]
        targets = rows[list(CATEGORIES)].to_numpy(np.float64)
        folds = np.arange(len(rows)) % FOLDS
        models, _ = fit_chain([np.asarray(s) for s in rows["slots"]], targets, folds)
        made = [(k, *model) for k, model in enumerate(models)]
        return pd.DataFrame(made, columns=["category", "slots", "weights", "extra"])

    fitted = sample.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(chain, MODEL_SCHEMA)
    # One row per category, each no longer than the feature space.
    return [tuple(row)[1:] for row in fitted.orderBy("category").collect()]


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` with a probability per category of the chain and the decision ``rejected``.

    Trained on at most ``fit_rows`` labelled rows, applied to whole texts of all rows. A null
    text has no words. Without any labels nothing is rejected. Columns of ``docs`` stay;
    those named like a result are replaced.
    """
    spark = docs.sparkSession
    models = train(labelled_sample(docs, labels, fit_rows), fit_rows)
    size = 1 << FEATURE_BITS
    table = np.zeros((len(models), size), np.float32)
    for k, (slots, weights, _) in enumerate(models):
        table[k, np.array(slots, np.int64)] = weights
    shared = spark.sparkContext.broadcast((table, [np.array(extra) for *_, extra in models]))
    fields = [T.StructField(name, T.DoubleType()) for name in CATEGORIES]
    state = {}

    @F.arrow_udf(T.StructType(fields))
    def probabilities(column: pa.Array) -> pa.Array:
        weights, extras = shared.value
        if not state:
            state["features"] = Features(wanted=(weights != 0).any(axis=0))
        known = state["features"]
        texts = column.to_pylist()
        sums = np.zeros((len(texts), len(weights)))
        for i, text in enumerate(texts):
            sums[i] = weights[:, known.of(text)].sum(axis=1)
        dense, columns = np.ones((len(texts), 1)), []
        for k, extra in enumerate(extras):
            columns.append(sigmoid(sums[:, k] + dense @ extra))
            dense = np.column_stack([dense, logit(columns[-1])])
        if not extras:
            columns = [np.zeros(len(texts)) for _ in CATEGORIES]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(CATEGORIES))

    found = docs.withColumn("__p", probabilities(F.col("text")))
    named = {f"p_{name}": F.col(f"__p.{name}") for name in CATEGORIES}
    return found.withColumns(named).drop("__p").withColumn("rejected", F.col(f"p_{CATEGORIES[-1]}") > THRESHOLD)


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    return toxicity(docs, labels).where(~F.col("rejected")).select(*docs.columns)
