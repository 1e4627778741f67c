"""Hard negatives against brute force and SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from crowding.llm import negatives, oracle, queries

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def brute(rows, every, k=5, m=10):
    ok = [
        (i, y, [int(np.floor(256 * float(x))) for x in v])
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, y, v in ok:
        if i % every == 0 and (i not in anchors or (y, v) < anchors[i]):
            anchors[i] = (y, v)
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted(
            (-sum(x * z for x, z in zip(v, w, strict=True)), j, y) for j, y, w in ok if j != a and len(w) == len(v)
        )
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            fit = [(j, -t) for t, j, y in scored if y != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, r, j, -s, t) for r, (j, t) in enumerate(fit[:m], 1)]
    return sorted(out)


def result(df, every, **how):
    out = negatives.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), **how)
    return sorted(tuple(r)[:6] for r in out.collect())


@pytest.mark.parametrize("size", [0.3, 1e6])
def test_equals_brute_force(spark, size):
    rng = np.random.default_rng(7)
    near = [(i, [float(x) for x in rng.normal(0.3, 1, 11) * size], int(rng.integers(3))) for i in range(150)]
    near += [(i, near[i - 150][1], 1) for i in range(150, 190)]  # ties
    near += [(10, [2 * size] * 11, 2), (33, near[3][1], None), (None, near[3][1], 1), (200, None, 1)]
    near += [(201, [NAN] * 11, 1), (202, [INF] * 11, 1), (203, [None] * 11, 1), (210, [1.0], 0), (211, [2.0], 0)]
    near += [(212, [1.0], 1), (220, [], 1), (221, [], 1), (222, [], 2), (230, [-1.0], 2)]
    df = spark.createDataFrame(near, "vec_id long, embedding array<double>, label int")
    df = df.withColumn("shard", F.lit("x")).withColumn("id", F.lit("y"))
    assert result(df, 10, tiles=(3, 40)) == brute(near, 10)


def test_merge_tree_has_levels(spark, monkeypatch):
    monkeypatch.setattr(negatives, "MERGE_FAN", 2)
    rows = [(i, [float(i % 9 + 1), 1.0], i % 4) for i in range(160)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = result(df, 40, tiles=(2, 9))
    assert got and got == brute(rows, 40)


def test_empty_table_and_no_anchor(spark):
    df = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert result(df.limit(0), 1) == [] and result(df, 100) == []


@pytest.mark.parametrize("low, high", [(0, 0), (-1, 0), (0, 1), (-128, 127), (-129, 127), (-(2**62), 2**62)])
def test_planes_hold_their_numbers(low, high):
    rows = np.array([[low, high, 0], [high, low, low]])
    bits = negatives.bits_of(rows)
    planes = negatives.bit_planes(rows, bits)
    back = [[sum((planes[w, 0, r] >> d & 1).item() * (-(1 << w) if w == bits - 1 else 1 << w) for w in range(bits))
             for d in range(3)] for r in range(2)]
    assert back == rows.tolist()


def test_tables_are_subset_sums():
    a = np.arange(1, 19).reshape(2, 9)
    tables = negatives.subset_sums(a)
    assert tables.shape == (2, 256, 2)
    assert tables[0, 0b10000101, 1] == 10 + 12 + 17 and tables[1, 1, 0] == 9 and tables[1, 0b10, 0] == 0


@pytest.mark.parametrize("size", [100, 10**7, 10**17])
def test_scores_are_exact(size):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-size, size, (5, 19)), rng.integers(-size, size, (7, 19))
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(p, q, strict=True)), -(2**63)), 2**63 - 1) for p in a] for q in b]
    got = np.concatenate([total for _, total in negatives.scores(a, b)], axis=1)
    assert got.tolist() == want


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(oracle.ORACLE["op11_negatives"]).fetchall()
    got = queries.QUERIES["op11_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
