"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (htmltext, imatch, importance, linequality, merkle, packing, pieces, simhash, substring, topk, toxicity,
               urlfilter, warc)
from .common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of each document, and whether they decode to it."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf_dir, "documents"), path, n=4, with_ids=False)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document, learned from labels that aren't held out."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each page's url."""
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back by byte ranges."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, length=2048)


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of each document and of its edited text, and their likeness."""
    found = imatch.fingerprint_documents(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, "") for c in ("fingerprint", "edited_fingerprint")})


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of ``documents``: 3-word shingles, at most 2 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` under 50-word windows that start in an earlier document go."""
    found = substring.deduplicate(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of each document, and whether it is kept once its host's common lines are gone."""
    found = linequality.judge(table(spark, sf_dir, "documents"), host_col="source")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, score and rank of each document against ``benchmark``; a quarter is drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, seed=7)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and tamper check of each document."""
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_toxicity, op3_url_filter, op4_warc, op5_packing, op6_imatch,
                                   op7_simhash, op8_topk, op9_html, op10_substring, op11_line_quality, op12_importance,
                                   op13_merkle)}
