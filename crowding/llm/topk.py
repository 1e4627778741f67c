"""Exact top-k search: tiled integer matrix products and a tree of merges.

Queries and candidates are cut into tiles. Each (query tile, candidate tile)
cell is one matrix product with a partial selection of the k best per query;
the short lists are then merged level by level. Tiles have a fixed number of
rows, so no task holds more than two tiles and a slice of their scores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_TILE = 2048
CANDIDATE_TILE = 4096
MERGE_FAN = 32
_SLICE = 256
_LOWEST = np.iinfo(np.int64).min


def quantised(vec: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as double; null for a vector that is
    null or holds a null, NaN or infinite component. A product beyond the long
    range takes its nearest end."""
    x = F.transform(vec, lambda c: c.cast("double"))
    bad = F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    return F.when(
        vec.isNotNull() & ~bad, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    )


def _matrices(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by vector length: {length: (row numbers, matrix)}."""
    arr = column.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    length = arr.value_lengths().to_numpy(zero_copy_only=False)
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    start = np.concatenate([[0], np.cumsum(length)])
    out = {}
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        out[int(d)] = (rows, flat[start[rows][:, None] + np.arange(d)])
    return out


def _largest(m: np.ndarray) -> int:
    return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as int64; a product beyond that takes its nearest end."""
    bound = _largest(a) * _largest(b) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best_in_tile(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k best in this tile.

    Ties go to the smaller candidate id; rows of the query's own id are left out.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    n = len(c_ids)
    out_q, out_c, out_s = [], [], []
    for lo in range(0, len(q_ids), _SLICE):
        ids = q_ids[lo : lo + _SLICE]
        score = _products(q[lo : lo + _SLICE], c)
        left = np.searchsorted(c_ids, ids, side="left")
        right = np.searchsorted(c_ids, ids, side="right")
        own = np.zeros(score.shape, bool)
        for i in np.flatnonzero(right > left):
            own[i, left[i] : right[i]] = True
        top = min(k, n)
        if _largest(score) < 2**62 // max(1, n):
            # One key per cell: score first, then the earlier candidate.
            key = score * n + np.arange(n - 1, -1, -1)
            key[own] = _LOWEST
            pick = np.argpartition(key, n - top, axis=1)[:, n - top :]
        else:
            pick = np.stack(
                [np.lexsort((np.arange(n), ~s, o))[:top] for s, o in zip(score, own, strict=True)]
            )
        row = np.repeat(np.arange(len(ids)), top)
        col = pick.ravel()
        keep = ~own[row, col]
        row, col = row[keep], col[keep]
        out_q.append(ids[row])
        out_c.append(c_ids[col])
        out_s.append(score[row, col])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_c, out_s))


def _cell(k: int):
    schema = pa.schema(
        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("shard", pa.int64())]
    )

    def run(key, queries: pa.Table, shard: pa.Table) -> pa.Table:
        parts = []
        q_ids, c_ids = (np.asarray(t.column("id"), dtype=np.int64) for t in (queries, shard))
        if len(q_ids) and len(c_ids):
            mine = _matrices(shard.column("v"))
            for d, (rows, q) in _matrices(queries.column("v")).items():
                if d in mine:
                    c_rows, c = mine[d]
                    parts.append(best_in_tile(q_ids[rows], q, c_ids[c_rows], c, k))
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
        tile = np.full(len(cols[0]), key[1].as_py(), np.int64)
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (*cols, tile)], schema=schema)

    return run


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    query_tile: int = QUERY_TILE,
    candidate_tile: int = CANDIDATE_TILE,
) -> DataFrame:
    """Each query's k highest integer inner products among all other rows.

    Returns query_id, rank (from 1), vec_id, score. Components become
    floor(scale * x). Ties go to the smaller vec_id. A query with fewer than k
    candidates has them all. Left out: rows with a null id, and vectors that
    are null or hold a null or non-finite component. Vectors meet only those of
    their own length (empty ones score 0). Rows that repeat a query's id are
    its own and no candidates of it; of a query id's repeated rows, the
    smallest vector asks. Other repeated rows are candidates each. An empty
    table gives an empty result; other columns are not read.
    """
    base = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            quantised(F.col(vec_col), scale).alias("v"),
            is_query.alias("asks"),
        )
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
    )
    n = base.agg(F.count("*").alias("n"), F.count_if(F.col("asks")).alias("q")).first()
    shards = max(1, math.ceil(n["n"] / candidate_tile))
    blocks = max(1, math.ceil(n["q"] / query_tile))

    def dealt(x: DataFrame, own: str, m: int, other: str, copies: int) -> DataFrame:
        # A row's place, not its id, picks its tile: repeated ids spread out.
        tile = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(m))
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))
        # New aliases: the two sides of a cogroup must not share attributes.
        mine = [F.col(c).alias(c) for c in ("id", "v")]
        return x.select(*mine, tile.alias(own)).select("*", copy.alias(other))

    asked = base.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    q = dealt(asked, "block", blocks, "shard", shards)
    c = dealt(base.select("id", "v"), "shard", shards, "block", blocks)
    lists = (
        q.groupBy("block", "shard")
        .cogroup(c.groupBy("block", "shard"))
        .applyInArrow(_cell(k), "query_id long, vec_id long, score long, shard long")
    )
    best = [F.desc("score"), F.asc("vec_id")]
    while True:
        shards = math.ceil(shards / MERGE_FAN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / MERGE_FAN))
        w = Window.partitionBy("query_id", "shard").orderBy(*best)
        lists = lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
