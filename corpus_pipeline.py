"""A corpus from raw documents to token ids: five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricetide.llm import mixing, ngram_join, quality_rules, sentencepieces, suffix_dedup
from pricetide.llm.shared import stage, table

#: Four fifths of the tokens that are left, in the target proportions, nothing twice.
RECIPE = mixing.Recipe(budget=800, epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or the limits of their language and source."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near duplicates."""
    return ngram_join.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 200 bytes and more that occur more than once; drop what has no text left."""
    return suffix_dedup.clean_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the token budgets of domains, languages and sources pay for."""
    return mixing.select_documents(docs, RECIPE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left: (doc_id, lang, source, n_tokens, ids)."""
    return sentencepieces.encode_documents(docs, public_tokenizers.path(sentencepieces.MODEL))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("source mixing", mixture),
    ("SentencePiece encoding", token_ids),
]

#: The last stage needs the model's pieces, which SQL does not have; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
