"""A training corpus from raw documents: language, exact and near copies, personal data, packing.

``STAGES`` are functions of (spark, docs, sf_dir); each reads what its predecessor kept.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerhouse.llm import pii  # noqa: E402
from layerhouse.llm.exact_dedup import drop_copies  # noqa: E402
from layerhouse.llm.inputs import table  # noqa: E402
from layerhouse.llm.language_id import drop_unknown, learn_profiles, learnable  # noqa: E402
from layerhouse.llm.near_dedup import drop_near_copies  # noqa: E402
from layerhouse.llm.packing import pack  # noqa: E402
from layerhouse.session import prepare, written  # noqa: E402

#: SQL cannot express the learned stages, so there is none; the tests follow the rows stage by stage.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; a missing language is filled if any language was learned."""
    prepare(spark)
    return drop_unknown(docs, learn_profiles(docs.where(learnable("doc_id", 4, 2))))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts stays."""
    prepare(spark)
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; all documents stay."""
    prepare(spark)
    masked = pii.redact(docs, pii.learn(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get places in sequences."""
    prepare(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written before the next stage reads it."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs)
    return docs
