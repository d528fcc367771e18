"""The operators as queries over the given tables, and the SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.llm import (
    alignment,
    chat,
    curves,
    fuse,
    lexical,
    minhash,
    mixing,
    pieces,
    sharding,
    simhash,
    substrings,
    toxicity,
    warc,
)
from trailmart.llm.common import table
from trailmart.llm.oracle import SQL  # noqa: F401

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def model_path(name: str = PIECE_MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.digests(pieces.documents_as_ids(docs, model_path()))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).drop("text")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.exact_dedup(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).drop("row")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("tie")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    saying = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        "select -7L as conv_id, array(named_struct('role', 'user', 'content', :t), "
        "named_struct('role', 'assistant', 'content', :t)) as messages",
        args={"t": saying},
    )
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations")).unionByName(chat.canonical_turns(extra))
    return chat.digests(chat.read_chats(chat.format_chats(turns)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("declared_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_tokenizer(table(spark, sf_dir, "documents"), model_path(BYTE_MODEL), model_path())


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_nearest": op2_nearest,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_chat_format": op9_chat_format,
    "op10_warc": op10_warc,
    "op11_minhash": op11_minhash,
    "op12_lexical": op12_lexical,
    "op13_alignment": op13_alignment,
}
