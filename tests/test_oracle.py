"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math
import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        vals = []
        for v in rec:
            if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                vals.append("NULL")
            elif isinstance(v, float):
                vals.append(repr(v))
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(str(v))
        out.append("|".join(vals))
    return cols, hashlib.sha1("\n".join(sorted(out)).encode()).hexdigest(), len(out)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(SQL) <= set(QUERIES)
    # Only training-data queries, where they are installed, go beyond SQL.
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(QUERIES) - set(SQL))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "csi" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.sql(SQL[name]).df()
    assert _canon(got) == _canon(want)
