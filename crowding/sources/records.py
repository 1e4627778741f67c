"""Text records read without loss: typed rows, and rejected ones with their reason.

A reader that casts while it parses turns what it can't read into null, and a
broken line into a row of nulls. Here every field is read as text first; a
record is rejected when the line has too few or too many fields, or when a field
that isn't empty doesn't make a value of its column's type. Rejected records
keep their text, their file and all reasons.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import lake
from .slices import previous_month

_KINDS = {"double": "number", "int": "number", "bigint": "number", "timestamp_ntz": "time", "timestamp": "time",
          "date": "date", "boolean": "boolean"}


def _typed(name: str, kind: str) -> Column:
    text = F.col(name)
    return text if kind == "string" else F.trim(text).try_cast(kind)


def checked(text: DataFrame, schema: T.StructType, broken: Column, record: Column, source_file: Column) -> DataFrame:
    """Rows of text fields as the schema's types, with ``reject_reason``, ``record``, ``source_file``.

    ``broken`` holds where the record itself is malformed, ``record`` is its
    text. A reason names every bad field ("number: ridership; time: ..."); good
    rows have none, and no record text. Empty fields are null, as a reader has them.
    """
    present = set(text.columns)
    reasons, typed = [], []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if f.name not in present:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = _typed(f.name, kind)
        typed.append(value.alias(f.name))
        if kind != "string":
            bad = value.isNull() & F.col(f.name).isNotNull() & (F.trim(F.col(f.name)) != "")
            reasons.append(F.when(bad, F.lit(f"{_KINDS.get(kind, kind)}: {f.name}")))
    fields = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    reason = F.when(broken, F.lit("number of fields")).otherwise(F.nullif(fields, F.lit("")))
    return text.select(
        *typed, reason.alias("reject_reason"), F.when(reason.isNotNull(), record).alias("record"), source_file.alias("source_file")
    )


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """All records of CSV files, checked against ``schema``; one pass over the files.

    With ``header``, a file whose first line doesn't name the schema's columns is
    an error rather than a shift of columns.
    """
    names = [f.name for f in schema.fields]
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_broken"]])
    reader = spark.read.schema(text_schema).option("columnNameOfCorruptRecord", "_broken").option("mode", "PERMISSIVE")
    # All fields are parsed, whatever is selected: the number of fields counts.
    reader = reader.option("header", header).option("enforceSchema", not header).option("columnPruning", False)
    text = reader.csv(path).withColumn("_file", F.col("_metadata.file_name"))
    record = F.coalesce(F.col("_broken"), F.to_csv(F.struct(*names)))
    return checked(text, schema, F.col("_broken").isNotNull(), record, F.col("_file"))


def good_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.where("reject_reason IS NULL").select(*[f.name for f in schema.fields])


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.where("reject_reason IS NOT NULL").select(*[f.name for f in schemas.REJECTED.fields])


def land_checked_month(
    rows: DataFrame, as_of: _dt.date, root: str, dataset: str, schema: T.StructType, ts_col: str
) -> str:
    """Land the month before ``as_of`` of checked rows as ``<dataset>_yyyy_MM``, and the rejects.

    Good rows of the month and all rejected records, whose month is not known
    for certain, go to two folders of one write, so the text is parsed once and
    both appear together. A repeated landing replaces both.
    """
    start, _ = previous_month(as_of)
    path = f"{root.rstrip('/')}/{dataset}_{start:%Y_%m}"
    keep = F.col("reject_reason").isNotNull()
    lower, upper = (F.lit(d).cast("timestamp_ntz") for d in (start, as_of.replace(day=1)))
    inside = (F.col(ts_col) >= lower) & (F.col(ts_col) < upper)
    (
        rows.where(keep | inside).withColumn("rejected", keep)
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    )
    return path


def _folder(spark: SparkSession, path: str, schema: T.StructType, rejected: bool) -> DataFrame:
    parts = T.StructType([*schema.fields, T.StructField("rejected", T.BooleanType())])
    return lake.read_table(spark, path, parts).where(F.col("rejected") == rejected).drop("rejected")


def read_good(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a checked landing; only their folder is read."""
    return _folder(spark, path, schema, False)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of a checked landing: source_file, reject_reason, record."""
    return _folder(spark, path, schemas.REJECTED, True)
