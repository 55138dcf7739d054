"""Corpus pipeline: documents through quality, language, near-duplicate,
mixing and packing stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before
kept, and returns a DataFrame that is written as Parquet and read back as
the next stage's docs.  All but the last return the columns of documents.
Stages that pass whole texts through Python write them themselves, in small
Arrow batches.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import jaccard, langid, mixing, packing, quality
from topicflow.llm.common import TEXTS_IN_BATCH, crc_mod, small_batches, staged, table
from topicflow.llm.queries import MIX_EPOCHS, MIX_FRACTION, MIX_SEED, MIX_WEIGHTS, WORD_BPE

# A document goes only where the models are sure: below these scores.
LEAST_QUALITY = 0.1
LEAST_LANGUAGE = 0.2


def kept(spark: SparkSession, docs: DataFrame) -> DataFrame:
    with small_batches(spark, TEXTS_IN_BATCH):
        return staged(spark, docs, "stage", compression="zstd")  # whole texts


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose probability of good quality is below
    LEAST_QUALITY; learned from the labels of two thirds of the ids.  Cases
    (nulls, empty and repeated rows, other columns) as in quality.good."""
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return kept(spark, quality.good(docs, model, LEAST_QUALITY))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of undetermined language or a score below
    LEAST_LANGUAGE; learned from the languages of three quarters of the ids.
    Cases as in langid.determined: null and wordless texts go."""
    model = langid.fit(spark, docs, crc_mod("doc_id", 4) != 2)
    return kept(spark, langid.determined(docs, model, LEAST_LANGUAGE))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component.  Cases as in
    jaccard.one_of_each: null and wordless texts and rows without an id stay."""
    return jaccard.one_of_each(spark, docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mixture; a document of the second epoch comes twice.  Cases
    as in mixing.mix: null languages and sources are leaves of their own."""
    return mixing.mix(spark, docs, MIX_FRACTION, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack every document left into sequences (one row per piece).  Cases as
    in packing.packed_documents."""
    return packing.packed_documents(spark, docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing_to_weights),
    ("best-fit packing", best_fit_packing),
]

STORED = (quality_classifier, language_id)

# The stages learn models and use a tokenizer, which SQL cannot express;
# tests/llm/test_pipeline.py compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES) and stage not in STORED:
            docs = staged(spark, docs, "stage", compression="zstd")
    return docs
