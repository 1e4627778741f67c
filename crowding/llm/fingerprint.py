"""Lempel-Ziv phrase fingerprints and their likeness.

A text's UTF-8 bytes are parsed into LZ78 phrases, each the longest phrase
seen before and one byte more. Every phrase's bytes are hashed; the hash's top
bits choose one of BINS bins, which keeps the smallest remainder. The
fingerprint is the bins' minima as hex. Texts that compress each other share
phrases, so the share of equal bins estimates the Jaccard similarity of their
phrase sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fmix
from .pretokens import text_groups

BINS = 128
_BIN_BITS = 7
_EMPTY = 0xFFFF
_MUL = np.uint64(0x9E3779B97F4A7C15)
_GROUP_CHARS = 1_000_000
#: Documents of a range of the order, where the session has partitions for it.
DOCS_A_RANGE = 2_000


def lz_phrases(data: bytes) -> dict[int, int]:
    """LZ78 phrases in order: 256 * number of the phrase before the last byte
    (0: none) + that byte, to 256 * the phrase's own number."""
    tree: dict[int, int] = {}
    get = tree.get
    at = last = 0
    for b in data:
        to = get(at + b)
        if to is None:
            last += 256
            tree[at + b] = last
            at = 0
        else:
            at = to
    return tree


def signatures(texts: list[str]) -> np.ndarray:
    """One row of BINS 16-bit minima per text; an empty bin is 0xFFFF."""
    keys, owner = [], []
    for t in texts:
        tree = lz_phrases(t.encode("utf-8"))
        keys.append(np.fromiter(tree, np.int64, len(tree)))
        owner.append(len(tree))
    out = np.full(len(texts) * BINS, _EMPTY, np.uint64)
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    if len(key):
        count = np.array(owner)
        base = np.repeat(np.cumsum(count) - count, count)
        parent = (key >> 8) - 1
        top = parent < 0
        parent += base
        value = (key & 255).astype(np.uint64) + np.uint64(1)
        h = np.zeros(len(key), np.uint64)
        done = top.copy()
        h[top] = fmix(value[top])
        rest = np.flatnonzero(~top)
        while len(rest):  # one step for each length of phrases
            ready = done[parent[rest]]
            now = rest[ready]
            h[now] = fmix(h[parent[now]] * _MUL + value[now])
            done[now] = True
            rest = rest[~ready]
        place = np.repeat(np.arange(len(texts)) * BINS, count) + (h >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
        least = np.minimum(h >> np.uint64(64 - _BIN_BITS - 16) & np.uint64(0xFFFF), np.uint64(_EMPTY - 1))
        np.minimum.at(out, place, least)
    return out.astype(np.uint16).reshape(len(texts), BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that aren't empty in both; 1 if all are."""
    used = (a != _EMPTY) | (b != _EMPTY)
    n = used.sum(axis=1)
    same = ((a == b) & used).sum(axis=1)
    return np.where(n == 0, 1.0, same / np.maximum(n, 1))


def as_text(signature: np.ndarray) -> list[str]:
    """Fingerprints as hex, four digits a bin."""
    raw = signature.astype(">u2").tobytes().hex()
    width = 4 * BINS
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every whole text; a null text counts as empty.

    Equal texts have equal fingerprints; an empty text has all bins empty. Ids
    may be null or repeat; an empty table gives an empty result; other columns
    are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_groups(batch.column(1).to_pylist(), _GROUP_CHARS):
                made = pa.array(as_text(signatures(texts)), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), made], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def _below(bounds: list[int], value: Column, inclusive: bool) -> Column:
    """How many of the ascending bounds are below ``value``, in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    test = (lambda b: b <= value) if inclusive else (lambda b: b < value)
    whole = F.size(F.filter(F.lit([g[-1] for g in groups]), test))
    table = F.array(*[F.lit(g) for g in groups])
    return whole * step + F.when(whole >= len(groups), F.lit(len(bounds) - len(groups) * step)).otherwise(
        F.size(F.filter(F.get(table, whole), test))
    )


def in_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Documents dealt into ranges of ascending (id, text hash), nulls last.

    Columns part, border, doc_id, text, h. A range also gets the next range's
    first document, with ``border``, and the last one the very first. The
    bounds are quantiles; an id with so many rows that it spans several ranges
    is dealt among them by the text's hash. Their number, and so what the
    driver holds, is at most 4 times the session's shuffle partitions.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    n, known = base.select("doc_id").agg(F.count("*"), F.count("doc_id")).first()
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-known // DOCS_A_RANGE), most))
    extra = 0 if n == known else max(1, min(-(-(n - known) // DOCS_A_RANGE), most))
    bounds: list[int] = []
    if parts > 1:
        share = [i / parts for i in range(1, parts)]
        bounds = list(base.agg(F.percentile_approx("doc_id", share, 10 * parts)).first()[0])
    unit = F.shiftrightunsigned("h", 40)  # 24 bits in the order of the hash as unsigned
    low, high = _below(bounds, F.col("doc_id"), False), _below(bounds, F.col("doc_id"), True)
    place = low + F.shiftright(unit * (high - low + 1), 24).cast("int")
    null_place = F.lit(parts) + F.shiftright(unit * F.lit(extra), 24).cast("int")
    placed = base.withColumn("part", F.when(F.col("doc_id").isNull(), null_place).otherwise(place).cast("int"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.shiftrightunsigned("h", 1).alias("u"), "h")
    heads = sorted(placed.groupBy("part").agg(F.min(order).alias("o")).collect(), key=lambda r: r["part"])
    rows = [(r["part"], heads[i - 1]["part"], r["o"]["doc_id"], r["o"]["h"]) for i, r in enumerate(heads)]
    first = spark.createDataFrame(rows, "part int, before int, head_id long, head_h long")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    own = F.struct("part", F.lit(False).alias("border"))
    also = F.struct(F.col("before").alias("part"), F.lit(True).alias("border"))
    dealt = (
        placed.join(F.broadcast(first), "part")
        .withColumn("to", F.explode(F.when(is_head, F.array(own, also)).otherwise(F.array(own))))
        .select("to.part", "to.border", "doc_id", "text", "h")
    )
    dealt = dealt.repartitionById(parts + extra, F.col("part")).sortWithinPartitions(
        "part", "border", F.col("doc_id").asc_nulls_last(), F.shiftrightunsigned("h", 1), "h"
    )
    return dealt, parts + extra


def compare_in_order(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the next.

    Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its last floor(n_chars / 2)
    code points replaced by the first as many (or all) of the next document's;
    next is by ascending doc_id (nulls last, ties by the text's hash), and the
    first after the last. A document alone is its own next. Null texts count
    as empty. Rows that repeat id and text stay rows. An empty table gives an
    empty result; other columns are not read.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def compared(ids: list, texts: list[str], own: np.ndarray) -> pa.RecordBatch:
        # The last of ``texts`` is only the next of the one before it.
        edited = []
        for t, follow in zip(texts[:-1], texts[1:], strict=True):
            half = len(t) // 2
            edited.append(t[: len(t) - half] + follow[:half])
        made = signatures(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array(edited, pa.string()), pa.array(as_text(own[:-1]), pa.string()), pa.array(as_text(made), pa.string()),
                pa.array(likeness(own[:-1], made)), pa.array(likeness(own[:-1], own[1:])),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ended = None, False  # the document that waits for its next: id, text, signature
        for batch in batches:
            border, all_ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            stop = border.index(True) + 1 if True in border else len(border)
            if ended:
                continue  # a border row again
            ended = True in border
            for first, texts in text_groups(batch.column(3).to_pylist()[:stop], _GROUP_CHARS):
                ids, own = all_ids[first : first + len(texts)], signatures(texts)
                if held:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], own])
                held = (ids[-1], texts[-1], own[-1:])
                if len(ids) > 1:
                    yield compared(ids, texts, own)

    dealt, _ = in_order(docs, id_col, text_col)
    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
