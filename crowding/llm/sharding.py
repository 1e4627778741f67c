"""Extendible-hash sharding: split only the buckets that are too large.

A row's key hash gives its path of bits. The directory starts with one bucket
and splits a bucket on its next bit while its bytes exceed the limit, so
shards have different depths. Sizes of all depths of a round come from one
pre-aggregated histogram; only rows of buckets that are still too large go on
to the next round. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bits of the key's hash, then bits of the row's place that part repeated keys.
KEY_BITS = 36
ROW_BITS = 24
BITS = KEY_BITS + ROW_BITS
#: Bits that one round can split: its histogram has 4096 rows a bucket at most.
ROUND_BITS = 12


def _bits(text: Column, n: int) -> Column:
    """The first ``n`` (a multiple of 4) bits of the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, n // 4), 16, 10).cast("long")


def assign_shards(
    df: DataFrame, key: Column, size: Column, limit: int, keep: dict[str, Column]
) -> DataFrame:
    """Shard of every row: the columns of ``keep``, n_bytes, depth, shard.

    ``shard`` is the first ``depth`` bits of the row's hash as a number, so
    (depth, shard) names a shard; depth is the smallest at which the bucket's
    bytes are within ``limit`` (0: everything fits in one). Null keys share
    one key, null sizes count as 0. Rows of one key differ only beyond
    KEY_BITS, where a hash of the row's place takes over, so a hot key splits
    too. A single row above the limit ends alone at full depth. An empty table
    gives an empty result; columns that aren't in ``keep`` are not read.
    """
    path = F.shiftleft(
        _bits(F.coalesce(key.cast("string"), F.lit("")), KEY_BITS), ROW_BITS
    ) + _bits(F.monotonically_increasing_id().cast("string"), ROW_BITS)
    kept = [c.alias(f"k{i}") for i, c in enumerate(keep.values())]
    rows = stored(
        df.select(
            *kept, F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("bytes"), path.alias("path")
        ),
        "shard-paths",
    )
    done = []
    depth = 0
    while True:
        fine = min(depth + ROUND_BITS, BITS)
        prefix = F.shiftright("path", BITS - fine)
        low = 0 if depth == 0 else depth + 1
        levels = (
            rows.groupBy(prefix.alias("fine"))
            .agg(F.sum("bytes").alias("bytes"))
            .select("fine", "bytes", F.explode(F.sequence(F.lit(low), F.lit(fine))).alias("depth"))
            .withColumn("shard", F.expr(f"shiftright(fine, {fine} - depth)"))
        )
        # At most 4096 histogram rows meet in one window.
        total = F.sum("bytes").over(Window.partitionBy("depth", "shard"))
        ends = F.lit(fine == BITS) & (F.col("depth") == fine)
        leaf = (
            levels.withColumn("total", total)
            .where((F.col("total") <= limit) | ends)
            .groupBy("fine")
            .agg(F.min("depth").alias("depth"))
        )
        placed = stored(
            rows.withColumn("fine", prefix).join(leaf, "fine", "left").drop("fine"), "shard-round"
        )
        done.append(placed.where(F.col("depth").isNotNull()))
        rows = placed.where(F.col("depth").isNull()).drop("depth")
        depth = fine
        if fine == BITS or rows.isEmpty():
            break
    out = reduce(DataFrame.unionByName, done)
    names = [F.col(f"k{i}").alias(n) for i, n in enumerate(keep)]
    shard = F.expr(f"shiftright(path, {BITS} - depth)")
    return out.select(
        *names, F.col("bytes").alias("n_bytes"), "depth", F.when(F.col("depth") > 0, shard).otherwise(0).alias("shard")
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Write rows that carry depth and shard as one folder a shard.

    The rebalance hint packs a shard's rows and splits a large one over tasks.
    """
    rows.hint("rebalance", "depth", "shard").write.partitionBy("depth", "shard").parquet(path)
