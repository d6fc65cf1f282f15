"""The corpus pipeline: five operators in a row over the documents, each on what the one before kept.

Every stage takes whole rows and texts. Null texts are empty texts: they are one group of exact copies, have fingerprint
0 and no words, so the mix takes none of them. Rows without a doc_id can't be labelled, lose against
equal texts with one, and otherwise go through like any other. Of repeated rows one passes exact dedup; the mix may take it more
than once. Ties go by each operator's own rule. Very long texts are neither cut nor dropped. The first four
stages return the documents' own columns, further ones whatever their names included; the last returns doc_id and ids.
An empty table of documents gives no rows, and without labels nothing is toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tastemill.llm import block_names, mixing, sentencepieces, simhash, toxicity
from tastemill.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return block_names.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.take_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids, with the checks of parity and round trip."""
    return sentencepieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Trained models, 64-bit hashes and token ids have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, make in STAGES:
        docs = stage(make(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
