"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes all that the one before it kept, and its result is written
before the next one reads it. All but the last return the columns of
``documents``: rejected documents are gone, and repeated passages are cut from
the texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crowding.llm import langid, minhash, packing, quality, suffixes
from crowding.llm.common import stored
from crowding.session import ensure_core_conf

#: A document stays if this share of its words at least is of one language.
LEAST_LANGUAGE_SHARE = 0.4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer accepts; it learns from all of them."""
    ensure_core_conf(spark)
    return quality.keep_accepted(docs, quality.fit(docs))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the model learns from those that name one.

    Where none does, there is nothing to tell languages by and all stay.
    """
    ensure_core_conf(spark)
    model = langid.fit(docs)
    return langid.keep_known(docs, model, LEAST_LANGUAGE_SHARE) if model.langs else docs


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the smallest doc_id."""
    ensure_core_conf(spark)
    return minhash.one_of_each(docs, minhash.near_duplicates(docs))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document has."""
    ensure_core_conf(spark)
    return suffixes.cut_passages(docs, suffixes.repeated_passages(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all texts, packed into sequences of 1024: one row a piece."""
    ensure_core_conf(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("packing", packing_stage),
]

#: Models, classes and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
