"""Registered queries: each operator over its whole table, with digests.

The operators return their real outputs; the queries derive the columns that
their contracts name. The tokenizer folder is that of ``public_tokenizers``,
which is installed on every machine.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    exact_dedup,
    fingerprint,
    langid,
    minhash,
    negatives,
    packing,
    preference,
    quality,
    sharding,
    suffixes,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Bytes of text that a shard may have: the given tables split at every scale.
SHARD_BYTES = 256 << 10


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document with the multilingual ranks and decode it again."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a scorer trained on weak labels."""
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs))


@_query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "keeps")


@_query
def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text; likeness to both neighbours."""
    out = fingerprint.compare_in_order(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@_query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the model learns from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    out = F.col("doc_id")
    model = langid.fit(docs.where(out.isNotNull() & ~langid.held_out(out)))
    return langid.predict(docs, model).select("doc_id", langid.held_out(out).alias("held_out"), "lang_pred", "score")


@_query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    out = packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query
def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier place has, and its document."""
    out = suffixes.repeated_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start_word", "n_words", "source_id")


@_query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard all documents by the hash of their id, within SHARD_BYTES of text."""
    docs = _table(spark, sf_dir, "documents")
    return sharding.assign_shards(
        docs, F.col("doc_id"), F.octet_length("text"), SHARD_BYTES, {"doc_id": F.col("doc_id")}
    )


@_query
def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preference pair for every conversation: its own last answer and its partner's."""
    turns = _table(spark, sf_dir, "conversations")
    pairs = preference.swapped_answer_pairs(turns, "conv_id", "turn", "role", "text")
    out = preference.preference_format(pairs, "conv", "chosen", "rejected")
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x["length"])
    text = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x["start"].cast("string"), x["length"].cast("string"))), ","
    )
    return out.select(
        F.col("pair_id").alias("conv_id"),
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        text("chosen_loss").alias("chosen_loss"),
        text("rejected_loss").alias("rejected_loss"),
        size("chosen_loss").alias("chosen_loss_chars"),
        size("rejected_loss").alias("rejected_loss_chars"),
    )


@_query
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for each vector whose id is divisible by 50."""
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@_query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100; a seventh of the labels is off by one."""
    rows = _table(spark, sf_dir, "embeddings")
    vec_id, label = F.col("vec_id"), F.col("label")
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    out = negatives.hard_negatives(rows, vec_id % 100 == 0, noisy)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@_query
def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays of each set of equal texts."""
    out = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align a byte-level and a sentencepiece tokenizer over every document."""
    return alignment.alignment(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
