"""Corpus pipeline: five operators in a row over the documents; every stage is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from framesift.llm import bpe, language, minhash, mixing, toxicity
from framesift.llm.common import crc_of, table
from framesift.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; labels with remainder 0 are never seen."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=crc_of(F.col("id")) % 5 != 0)
    return toxicity.kept_documents(docs, lexicon)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and sure."""
    return language.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: that with the smallest id."""
    return minhash.kept_documents(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts that the mix takes of every document."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of the bytes decoded from them."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode_documents(docs.select("doc_id", "source", "text"), tokenizer)
    return bpe.decode_documents(encoded, tokenizer).select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        bpe.digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing_sources", mix_sources),
    ("byte_bpe", encode),
]

#: Learned lexicons, register hashes and permutations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


#: Rows that travel to a Python worker at once.  Workers serve one stage after the other and keep the room of their largest batch.
BATCH = 2_000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH:  # the last stage runs later, so the setting stays
        spark.conf.set(rows, str(BATCH))
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
