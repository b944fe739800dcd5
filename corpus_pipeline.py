"""A corpus pipeline: documents that are of quality, no near copy of another, without repeated passages or benchmark text, as token ids.

Each stage takes the documents its predecessor kept, whole, and its decisions take effect: rows go, or text is cut. All but the last return the columns of
documents (with ``n_chars`` of the text as it then is).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import bpe, decontaminate, minhash, quality, repeats
from spanloom.llm.shared import read, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more; the model learns from labelled documents of the input tables, those held out excepted."""
    labels = read(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    model = quality.train(read(spark, sf_dir, "documents"), labels)
    return quality.score(docs, model, "_quality").where("_quality >= 0.5").drop("_quality")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.drop_near_copies(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes or more that stand earlier in the corpus."""
    return repeats.drop_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark items."""
    clean = decontaminate.remove_spans(docs, read(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every text."""
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode_documents(docs, vocabulary)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: Signatures, a trained model and byte-pair merges are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
