"""Corpus pipeline: toxicity, SimHash near-dedup, substring dedup, best-fit packing.

Every stage takes what its predecessor kept, as Parquet.  All but the last return the columns of the
documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import packing, simhash, substring, toxicity
from tidemark.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold stay, all columns.

    Null and empty texts score by the intercept and stay; repeated rows share their fate; null ids have no
    labels; a score at the threshold goes; any further columns are carried along; no rows give none.
    """
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at most two bits apart stays, all columns.

    That is the smallest id's; null ids come last, and equal ids (ties) go by text hash, so of repeated rows one stays.  Null and
    empty texts are one component; any further columns are carried along; no rows give none.
    """
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of smaller id has go out of the texts; ``n_chars`` follows.

    All rows stay, with empty texts where nothing is left.  Null texts stay null; rows with a null id or of one id take
    nothing from each other; any further columns are carried along; no rows give none.
    """
    return substring.cut_texts(docs, window=50)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens, one row per piece.

    Null and empty texts are the single end token; null ids and repeated rows are packed like any; pieces of equal length
    go by id, piece and checksum; further columns are left out; no rows give none.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), length=2048)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies),
          ("substring_dedup", drop_repeats), ("best_fit_packing", pack_sequences)]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
