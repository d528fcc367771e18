"""Corpus pipeline: toxic documents out, copies out, sources mixed, texts encoded."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trailmart.llm import fuse, mixing, pieces, simhash, toxicity  # noqa: E402
from trailmart.llm.common import delete, prepare, saved, table  # noqa: E402
from trailmart.llm.queries import model_path  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labels, does not reject."""
    prepare(spark)
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    prepare(spark)
    return fuse.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints of four-word shingles at most 4 bits apart the row with the smallest doc_id stays."""
    prepare(spark)
    return simhash.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of pieces and hashes of ids and decoded text of every row."""
    prepare(spark)
    return pieces.digests(pieces.documents_as_ids(docs, model_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each reading what the one before has written to the shared folder, which then goes."""
    docs, read = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs, path = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        delete(spark, *read)
        read = [path]
    return docs


#: The mix draws by Spark's hashes and SentencePiece has no SQL form.
ORACLE_SQL = None
