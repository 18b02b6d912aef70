"""A corpus from raw documents: good ones, one of each group of near copies, mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as parquet
to the shared folder and reads it back as the next stage's documents. All stages but the last
return the columns of `documents`, whatever their number and names.

Every stage takes null ids, null, empty and very long texts, ties and repeated rows, and gives an empty
table for an empty one; what becomes of such rows is said at each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fareloom.llm import mixing, ngram_jaccard, packing, quality
from fareloom.llm.queries import TOKENIZER
from fareloom.sources.staging import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject. Null and empty texts get a score as all others do;
    rows of equal text get the same one, and a repeated row stays as often as it is there."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies: words in shingles of five, likeness of 0.8 or more; one of each group stays,
    the one with the smallest id, rows without id last. Different texts under one id are two documents.
    Texts without words are near nothing; those without an id all stay, others once for each id."""
    return ngram_jaccard.one_of_each(docs, words=5, percent=80)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order. A null source is a source of its own;
    texts without words have size 0."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096. A null text is packed as an empty one: its
    end token alone. Which of equally long pieces lies where has no meaning."""
    return packing.best_fit_packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

# Compression, tokenizers and bin completion have no SQL; see test_pipeline in
# tests/llm/test_operators.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
