"""Hard negatives by Four-Russians scoring of exact integer inner products.

Dimensions are taken eight at a time. For each group of eight an anchor has a
table of its 256 subset sums. A candidate's components, in two's complement,
are cut into bit planes; the eight bits of one plane and group are a byte. The
sum of the tables at a plane's bytes is the inner product of the anchor with
that plane, and planes are added with shifts, the highest one negative.

Anchors and candidates meet in cells of a tile each: once for each anchor's
best positives, and again, with the positives' scores known, for the negatives
in the range of scores that each positive allows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .topk import quantised

ANCHOR_TILE = 512
CANDIDATE_TILE = 4096
MERGE_FAN = 32
#: Bytes of tables and scores at a time.
_SLICE_BYTES = 16 << 20


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (group, byte, anchor): the sum of the components that a byte's bits name."""
    n, d = anchors.shape
    groups = -(-d // 8)
    padded = np.zeros((n, 8 * groups), anchors.dtype)
    padded[:, :d] = anchors
    out = np.zeros((groups, 256, n), anchors.dtype)
    for bit in range(8):  # each bit doubles what the lower ones made
        size = 1 << bit
        out[:, size : 2 * size] = out[:, :size] + padded[:, bit::8].T[:, None, :]
    return out


def bit_planes(rows: np.ndarray, bits: int) -> np.ndarray:
    """Bytes (plane, group, row) of two's complement components of ``bits`` bits."""
    planes = np.empty((bits, -(-rows.shape[1] // 8), len(rows)), np.uint8)
    for w in range(bits):
        planes[w] = np.packbits((rows >> w & 1).astype(np.uint8), axis=1, bitorder="little").T
    return planes


def bits_of(rows: np.ndarray) -> int:
    """Bits that two's complement needs for every component."""
    low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
    return 1 + max((-low - 1).bit_length() if low < 0 else 0, high.bit_length() if high > 0 else 0)


def scores(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Exact inner products of all rows with slices of anchors: (first anchor, (row, anchor)).

    Integers of 32 bits where no sum can leave them, else of 64, else Python's;
    a product beyond 64 bits takes the nearest end.
    """
    bits = bits_of(rows)
    planes = bit_planes(rows, bits)
    most = sum(max(-int(x), int(y)) for x, y in zip(anchors.min(axis=0), anchors.max(axis=0), strict=True))
    bound = (most + 1) << (bits + 1)
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
    each = 2048 * max(1, planes.shape[1]) + 16 * len(rows)
    step = max(1, _SLICE_BYTES // each)
    for lo in range(0, len(anchors), step):
        part = anchors[lo : lo + step].astype(kind)
        tables = subset_sums(part)
        total = np.zeros((len(rows), len(part)), kind)
        for w in range(bits - 1, -1, -1):
            # Shift by one plane, then add; the sign plane counts negative.
            if kind is object:
                total = total * 2
            else:
                total <<= 1
            for table, index in zip(tables, planes[w], strict=True):
                if w == bits - 1:
                    total -= table[index]
                else:
                    total += table[index]
        if kind is object:
            total = np.clip(total, -(2**63), 2**63 - 1)
        yield lo, total.astype(np.int64)


def _matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of the vector column by length: {length: (row numbers, matrix)}."""
    arr = table.column("v").combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    size = arr.value_lengths().to_numpy(zero_copy_only=False)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    begin = np.cumsum(size) - size
    return {
        int(d): (rows, flat[begin[rows][:, None] + np.arange(d)])
        for d in np.unique(size)
        for rows in [np.flatnonzero(size == d)]
    }


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name), dtype=np.int64)


def _in_order(ids: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Row numbers by falling score, ties by id; ``ids`` rises."""
    return np.argsort(-total, kind="stable") if total.min(initial=0) > -(2**63) else np.lexsort((ids, ~total))


def _cell(pick: Callable, schema: pa.Schema):
    """Score a tile of anchors against a tile of candidates; ``pick`` selects."""

    def run(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            mine = _matrices(rows)
            ids, labels = _column(rows, "id"), _column(rows, "label")
            for d, (at, q) in _matrices(anchors).items():
                if d not in mine:
                    continue
                place, c = mine[d]
                for lo, total in scores(q, c):
                    for i in range(total.shape[1]):
                        out += pick(anchors, int(at[lo + i]), ids[place], labels[place], total[:, i])
        shard = key[1].as_py()
        cols = list(zip(*out, strict=True)) or [[]] * (len(schema) - 1)
        arrays = [pa.array(x, f.type) for x, f in zip(cols, schema, strict=False)]
        return pa.Table.from_arrays([*arrays, pa.array([shard] * len(out), pa.int64())], schema=schema)

    return run


def _positive_picker(k: int):
    def pick(anchors, at, ids, labels, total):
        own, label = anchors.column("id")[at].as_py(), anchors.column("label")[at].as_py()
        near = np.flatnonzero((labels == label) & (ids != own))
        best = near[_in_order(ids[near], total[near])[:k]]
        return [(own, i, s) for i, s in zip(ids[best].tolist(), total[best].tolist(), strict=True)]

    return pick


def _negative_picker(k: int, least: int, most: int):
    def pick(anchors, at, ids, labels, total):
        own, label = anchors.column("id")[at].as_py(), anchors.column("label")[at].as_py()
        far = np.flatnonzero((labels != label) & (ids != own))
        far = far[_in_order(ids[far], total[far])]
        falling = ~total[far]  # rises where the score falls; has no overflow
        out = []
        for p in anchors.column("positives")[at].as_py():
            low, high = -(-least * p["score"] // 100), most * p["score"] // 100
            if low > high or high < -(2**63) or low > 2**63 - 1:
                continue
            begin = int(np.searchsorted(falling, ~min(high, 2**63 - 1), side="left"))
            for j in far[begin : begin + k].tolist():
                if total[j] < low:
                    break
                out.append((own, p["rank"], int(ids[j]), int(total[j])))
        return out

    return pick


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, pick, names: list[str], tiles) -> DataFrame:
    """Every tile of anchors with every tile of rows, and the merged lists' shards."""
    anchor_tile, row_tile = tiles
    blocks, shards = max(1, math.ceil(n_anchors / anchor_tile)), max(1, math.ceil(n_rows / row_tile))

    def dealt(x: DataFrame, own: str, m: int, other: str, copies: int) -> DataFrame:
        tile = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(m))
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))
        # New aliases: the two sides of a cogroup must not share attributes.
        mine = [F.col(c).alias(c) for c in x.columns]
        return x.select(*mine, tile.alias(own)).select("*", copy.alias(other))

    schema = pa.schema([(n, pa.int64()) for n in [*names, "shard"]])
    a = dealt(anchors, "block", blocks, "shard", shards)
    c = dealt(rows, "shard", shards, "block", blocks)
    return (
        a.groupBy("block", "shard").cogroup(c.groupBy("block", "shard"))
        .applyInArrow(_cell(pick, schema), ", ".join(f"{n} long" for n in schema.names))
    )


def _merged(lists: DataFrame, shards: int, key: list[str], k: int) -> DataFrame:
    """The k best of each key from its lists of all shards, a fan of lists at a time."""
    best = [F.desc("score"), F.asc("found_id")]
    while True:
        shards = math.ceil(shards / MERGE_FAN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / MERGE_FAN))
        w = Window.partitionBy(*key, "shard").orderBy(*best)
        lists = lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if shards <= 1:
            return lists.drop("shard")
        lists = lists.drop("rank")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    tiles: tuple[int, int] = (ANCHOR_TILE, CANDIDATE_TILE),
) -> DataFrame:
    """For each anchor and positive, the best rows of other labels in the positive's range.

    Components become floor(scale * x); a row's score is its inner product with
    the anchor, ties go to the smaller id. Positives are the anchor's first
    ``positives`` other rows of its label; negatives the first ``negatives`` rows
    of another label with least * p <= 100 * score <= most * p, p the
    positive's score (none, where p is negative). Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score, and
    positive_rank. Left out: rows with a null id or label, and vectors that are
    null or hold a null or non-finite component. Vectors meet those of their
    own length only (empty ones score 0). Rows that repeat an anchor's id are
    its own, neither positives nor negatives of it; of an anchor id's repeated
    rows the one with the smallest label, then vector, asks. Other repeated
    rows count each. An empty table gives an empty result; other columns are
    not read.
    """
    base = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        quantised(F.col(vec_col), scale).alias("v"), is_anchor.alias("asks"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    anchors = base.where("asks").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    rows = base.select("id", "label", "v")
    n = base.agg(F.count("*").alias("n"), F.count_if("asks").alias("a")).first()
    shards = max(1, math.ceil(n["n"] / tiles[1]))
    near = _cells(anchors, rows, n["a"], n["n"], _positive_picker(positives), ["id", "found_id", "score"], tiles)
    near = stored(_merged(near, shards, ["id"], positives), "positives")
    known = near.groupBy("id").agg(F.collect_list(F.struct(F.col("rank").cast("long").alias("rank"), "score")).alias("positives"))
    asking = anchors.join(known, "id")
    far = _cells(
        asking, rows, n["a"], n["n"], _negative_picker(negatives, least, most), ["id", "positive_rank", "found_id", "score"], tiles
    )
    far = _merged(far, shards, ["id", "positive_rank"], negatives)
    mine = near.select("id", F.col("rank").cast("long").alias("positive_rank"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(mine, ["id", "positive_rank"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), F.col("positive_rank").cast("int").alias("positive_rank"),
    )
