"""Landed extracts: paged CSV files and monthly raw files.

The reference pulls pages over HTTP and concatenates them in memory; here the
pages are files in a landing folder and a multi-file read is their union.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import numbered
from .lake import exists
from .slices import coerce_numeric, previous_month, previous_month_slice

# Fixed value: rows per extract page.
PAGE_ROWS = 50_000

#: Lots that a landing of fixed pages has at most, however many pages there are.
MOST_LOTS = 32


def land_pages(records: DataFrame, path: str, order_cols=("transit_timestamp", "station_complex_id"),
               page_rows: int | None = None) -> None:
    """Write records as ordered CSV pages, of at most ``page_rows`` rows where given."""
    writer = records.orderBy(*order_cols).write.mode("overwrite").option("header", True)
    if page_rows:
        writer = writer.option("maxRecordsPerFile", page_rows)
    writer.csv(path)


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed pages as one DataFrame (a multi-file scan is the union)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def land_month(records: DataFrame, as_of: _dt.date, root: str, dataset: str,
               ts_col: str, numeric_cols) -> str:
    """Slice the previous month, coerce numerics, write ``<dataset>_yyyy_MM``."""
    start, _ = previous_month(as_of)
    path = f"{root.rstrip('/')}/{dataset}_{start:%Y_%m}"
    month = coerce_numeric(previous_month_slice(records, as_of, ts_col), numeric_cols)
    month.write.mode("overwrite").parquet(path)
    return path


# -- pages of a fixed size -----------------------------------------------------
MANIFEST = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("page", "first_row", "n_rows")]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(page, first_row, n_rows) of the pages that have landed."""
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/_manifest")


def land_fixed_pages(
    records: DataFrame,
    path: str,
    order_cols=("transit_timestamp", "station_complex_id"),
    page_rows: int = PAGE_ROWS,
    pages_a_job: int = 1000,
    most_jobs: int | None = None,
) -> int:
    """Land records as numbered CSV pages of exactly ``page_rows`` rows, in order.

    Page p holds the rows p * page_rows + 1 and on of the whole order; only the
    last page may have fewer. Rows that tie keep an order of their own, fixed
    when they are first numbered. A page is one file in the folder ``page=p``.
    Rows are numbered once and kept beside the pages, then the manifest begins
    without a line; ``pages_a_job`` pages land at a time, each lot followed by
    its lines of the manifest. Where that makes more than MOST_LOTS lots, the
    pages are dealt over so many: a lot costs jobs of its own, so their number
    must not grow with the rows, and a failure still repeats one lot alone. A landing
    that stopped, by a failure or after ``most_jobs`` lots, goes on at the first
    page that the manifest lacks, with the numbers of its first start. Returns
    how many pages have landed. No rows land as no page.
    """
    spark, path = records.sparkSession, path.rstrip("/")
    rows_path, pages_path = f"{path}/_rows", f"{path}/pages"
    numbers, manifest = f"{path}/_numbered", f"{path}/_manifest"
    if not exists(spark, manifest):
        rows = numbered(records, [F.col(c) for c in order_cols], rows_path, "_row")
        rows.withColumn("_page", F.floor((F.col("_row") - 1) / page_rows)).write.mode("overwrite").parquet(numbers)
        spark.createDataFrame([], MANIFEST).write.mode("append").parquet(manifest)
    rows = spark.read.parquet(numbers)
    last = rows.agg(F.max("_page").alias("p")).first()["p"]
    total = 0 if last is None else last + 1
    done = read_manifest(spark, path).agg(F.max("page").alias("p")).first()["p"]
    first = 0 if done is None else done + 1
    lot_pages = max(pages_a_job, -(-total // MOST_LOTS))
    jobs = 0
    while first < total and (most_jobs is None or jobs < most_jobs):
        after = min(first + lot_pages, total)
        lot = rows.where((F.col("_page") >= first) & (F.col("_page") < after))
        # All rows of a page meet in one task; a page is small by definition.
        (
            lot.repartition("_page").sortWithinPartitions("_page", "_row").withColumn("page", F.col("_page"))
            .drop("_page", "_row")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("header", True).partitionBy("page").csv(pages_path)
        )
        (
            lot.groupBy(F.col("_page").alias("page")).agg(F.min("_row").alias("first_row"), F.count("*").alias("n_rows"))
            .coalesce(1).write.mode("append").parquet(manifest)
        )
        first, jobs = after, jobs + 1
    return first


def read_fixed_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed pages as one table with the column ``page``; a range of pages prunes folders."""
    numbered_schema = T.StructType([*schema.fields, T.StructField("page", T.LongType())])
    return spark.read.schema(numbered_schema).option("header", True).csv(f"{path.rstrip('/')}/pages")
