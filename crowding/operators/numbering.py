"""Row numbers and ranks over a total order, without one task that sees it all.

A window without a partition, or over one large group, runs in a single task.
Here rows are range partitioned by the order and sorted inside each partition,
and what a task can't know, how many rows lie in the partitions before, comes
from a prefix sum over one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A task's monotonic ids count its rows from 0 in the lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def stored_in_order(df: DataFrame, order: list[Column], path: str) -> DataFrame:
    """Write ``df`` range partitioned and sorted by ``order``; read it back.

    Adds ``_part`` (place of the range) and ``_at`` (row in it, from 0). Rows
    that tie are told apart by their place in the input, so a value that a third
    of all rows share is split over partitions too. What was written is what
    counts: a task that runs again, or a later read, finds the same numbers.
    """
    spark = df.sparkSession
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tie.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, "_tie")
    place = F.monotonically_increasing_id()
    ranged.drop("_tie").withColumns(
        {"_part": F.spark_partition_id(), "_at": place.bitwiseAND(F.lit(_ROW_BITS))}
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rows_before(parts: DataFrame) -> DataFrame:
    """(_part, _before) from (_part, n): rows in all earlier partitions.

    One row per partition of a shuffle goes in, so the single window is as
    small as the list of tasks.
    """
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, order: list[Column], path: str | None = None, name: str = "row_number") -> DataFrame:
    """``df`` with its row number (from 1) in the whole order.

    The numbered rows are kept under ``path`` (default: a fresh scratch
    folder). Ties get consecutive numbers in the order of the input.
    """
    rows = stored_in_order(df, order, path or scratch_path(df.sparkSession, "in-order"))
    before = rows_before(rows.groupBy("_part").agg(F.count("*").alias("n")))
    # One row per shuffle partition: bounded by the cluster's own setting.
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop(
        "_part", "_at", "_before"
    )


def group_ranks(
    df: DataFrame,
    group: list[str],
    value: str,
    *,
    descending: bool = False,
    nulls_last: bool = False,
    dense: str = "dense_rank",
    percent: str = "percent_rank",
) -> DataFrame:
    """``df`` with the exact dense and percent rank of ``value`` in its group.

    Equals ``dense_rank`` and ``percent_rank`` over a window of the group, for
    groups too large for one task. Equal values are combined first, so ties,
    however many, are one row of the order; the distinct values are range
    partitioned by (group, value), and each gets the number of values and of
    rows before it: inside its partition from a window over (partition, group),
    before its partition from a prefix sum over a group's partitions.
    """
    path = scratch_path(df.sparkSession, "group-values")
    side = {(False, False): F.asc_nulls_first, (False, True): F.asc_nulls_last,
            (True, False): F.desc_nulls_first, (True, True): F.desc_nulls_last}[(descending, nulls_last)]
    values = df.groupBy(*group, value).agg(F.count("*").alias("_rows"))
    order = [*map(F.col, group), side(value)]
    values.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    values = df.sparkSession.read.parquet(path)
    totals = values.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.sum("_rows").alias("_m"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = totals.select(
        *group, "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_values_before"),
        F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_m").over(whole).alias("_group_rows"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(side(value))
    here = values.withColumns(
        {
            "_value_no": F.row_number().over(inside),
            "_rows_here": F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows"),
        }
    )
    same = here["_part"] == totals["_part"]
    for g in group:
        same = same & here[g].eqNullSafe(totals[g])
    ranks = here.join(totals, same).select(
        *[here[g].alias(f"_g_{g}") for g in group],
        here[value].alias("_value"),
        (F.col("_values_before") + F.col("_value_no")).cast("int").alias(dense),
        F.when(F.col("_group_rows") == 1, F.lit(0.0))
        .otherwise((F.col("_rows_before") + F.col("_rows_here")) / (F.col("_group_rows") - 1))
        .alias(percent),
    )
    mine = df[value].eqNullSafe(ranks["_value"])
    for g in group:
        mine = mine & df[g].eqNullSafe(ranks[f"_g_{g}"])
    return df.join(ranks, mine).drop("_value", *[f"_g_{g}" for g in group])
