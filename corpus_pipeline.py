"""Training-data pipeline over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns the columns of ``documents``; the last returns the encoding.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.llm import byte_bpe, exact_dedup, lang_id, mixing, near_copies
from roadtally.llm.common import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is found; a document without letters goes, others stay even where no label teaches a language."""
    found = lang_id.identify(docs, docs.where(~lang_id.held_out(F.col("doc_id"))), out_col="__found")
    return found.where((F.col("__found.lang_pred") != "und") | F.col("text").rlike(r"\p{L}")).drop("__found")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts, white space aside."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group linked by five-word similarities of 0.8 or more."""
    return near_copies.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source targets take them, in training order."""
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, little-endian unsigned 32-bit, and digests of ids and decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = byte_bpe.encode_bpe(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return rows.select("doc_id", "lang", "source", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Fingerprints, suffix automata and byte-pair merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
