"""Top-k search, sharding and preference formatting against brute force and SQL."""

import hashlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from crowding.llm import oracle, preference, queries, sharding, topk

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def brute_top_k(rows, k, every):
    ok = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in ok:
        if i % every == 0 and (i not in asked or v < asked[i]):
            asked[i] = v
    out = []
    for q, v in asked.items():
        all_ = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != q and len(w) == len(v)]
        out += [(q, r, j, -s) for r, (s, j) in enumerate(sorted(all_)[:k], 1)]
    return sorted(out)


def test_top_k_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=4))]) for i in range(200)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 260)]  # ties
    rows += [(0, [0.5, 0.0, 0.0, 0.0]), (7, rows[7][1]), (None, [1.0] * 4), (300, None), (301, [None, 1.0, 1.0, 1.0])]
    rows += [(302, [NAN, 1.0, 1.0, 1.0]), (303, [INF, 1.0, 1.0, 1.0]), (310, [2.0, 3.0]), (311, [1.0, 1.0]), (320, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, shard string")
    got = topk.exact_top_k(df, F.col("vec_id") % 10 == 0, k=5, query_tile=7, candidate_tile=23).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows, 5, 10)
    assert topk.exact_top_k(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e6, 1e17])
def test_products_are_exact(size):
    rng = np.random.default_rng(5)
    a, b = (rng.integers(-size, size, (6, 3)) for _ in "ab")
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(p, q, strict=True)), -(2**63)), 2**63 - 1) for q in b] for p in a]
    assert topk._products(a, b).tolist() == want


def test_merge_tree_has_levels(spark, monkeypatch):
    monkeypatch.setattr(topk, "MERGE_FAN", 2)
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(120)], "vec_id long, embedding array<float>")
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, k=3, candidate_tile=10).collect()
    assert sorted(map(tuple, got)) == brute_top_k([(i, [i % 7, 1.0]) for i in range(120)], 3, 50)


def brute_shards(items, limit):
    """(id -> (depth, shard)) by splitting buckets one bit at a time."""
    path = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:9], 16) for i, _ in items}
    out, open_ = {}, [(0, 0, items)]
    while open_:
        depth, shard, rows = open_.pop()
        if sum(s for _, s in rows) <= limit:
            out |= {i: (depth, shard) for i, _ in rows}
            continue
        for bit in (0, 1):
            part = [(i, s) for i, s in rows if path[i] >> (35 - depth) & 1 == bit]
            open_.append((depth + 1, shard << 1 | bit, part))
    return out


def test_shards_split_only_what_is_too_large(spark):
    items = [(i, (i * 37) % 101) for i in range(3000)]
    df = spark.createDataFrame(items, "doc_id long, size long")
    out = sharding.assign_shards(df, F.col("doc_id"), F.col("size"), 900, {"doc_id": F.col("doc_id")}).collect()
    assert {r["doc_id"]: (r["depth"], r["shard"]) for r in out} == brute_shards(items, 900)


def test_shards_of_hot_null_and_huge_rows(spark):
    rows = [(1, 10)] * 500 + [(None, 10)] * 50 + [(2, 100_000), (3, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k long, size long, path string")
    out = sharding.assign_shards(df, F.col("k"), F.col("size"), 100, {"k": F.col("k")}).collect()
    assert len(out) == len(rows)
    load = {}
    for r in out:
        load.setdefault((r["depth"], r["shard"]), []).append(r["n_bytes"])
    assert all(sum(x) <= 100 or len(x) == 1 for x in load.values())
    empty = sharding.assign_shards(df.limit(0), F.col("k"), F.col("size"), 100, {"k": F.col("k")})
    assert empty.count() == 0 and empty.columns == ["k", "n_bytes", "depth", "shard"]


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, 10) for i in range(100)], "doc_id long, size long")
    out = sharding.assign_shards(df, F.col("doc_id"), F.col("size"), 200, {"doc_id": F.col("doc_id")})
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r["doc_id"] for r in back.collect()) == list(range(100))


def turns(*pairs):
    return [{"role": r, "text": t} for r, t in pairs]


def test_preference_cases(spark):
    u, a, b = ("user", "hé?"), ("assistant", "yes"), ("assistant", "no")
    rows = [
        (1, turns(u, a), turns(u, b)),
        (2, turns(u, a), turns(u, a)),
        (3, turns(u), turns(u, b)),
        (4, None, turns(b)),
        (5, [], []),
        (6, turns(a), turns(b)),
    ]
    df = spark.createDataFrame(
        [(*r, "x") for r in rows],
        f"pair long, c {preference.TURNS}, r {preference.TURNS}, prompt string",
    )
    got = {r["pair_id"]: r for r in preference.preference_format(df, "pair", "c", "r").collect()}
    assert [got[i]["n_common"] for i in range(1, 7)] == [1, 2, 1, 0, 0, 0]
    assert got[1]["prompt"] == "<|user|>\nhé?\n<|end|>\n"
    for i, side in ((1, "chosen"), (1, "rejected"), (3, "rejected"), (4, "rejected"), (6, "chosen")):
        whole = got[i]["prompt"] + got[i][side]
        spans = [whole[s["start"] : s["start"] + s["length"]] for s in got[i][f"{side}_loss"]]
        assert spans == ["yes" if side == "chosen" else "no"], (i, side)
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["chosen_loss"] == []
    assert got[5]["prompt"] == "" and got[4]["chosen"] == ""
    assert preference.preference_format(df.limit(0), "pair", "c", "r").count() == 0


def test_swapped_answers_edge_rows(spark):
    rows = [
        (2, 1, "assistant", "A"), (2, 0, "user", "q"), (3, 0, "assistant", "B"), (3, 1, "user", None),
        (4, 0, "user", "alone"), (6, 0, None, None), (None, 0, "user", "nobody"), (8, 0, "assistant", "C"),
        (8, 0, "assistant", "C"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv"]: r for r in preference.swapped_answer_pairs(df, "conv_id", "turn", "role", "text").collect()}
    said = lambda x: [t["text"] for t in x]
    assert said(out[2]["chosen"]) == ["q", "A"] and said(out[2]["rejected"]) == ["q", "B"]
    assert said(out[3]["rejected"]) == ["A", ""] and said(out[4]["rejected"]) == ["alone"]
    assert said(out[8]["chosen"]) == ["C", "C"] and said(out[8]["rejected"]) == ["C", ""]
    assert None not in out and said(out[6]["chosen"]) == [""]


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    want = con.sql(oracle.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = sorted(map(tuple, got.select(*columns).collect()))
    assert rows == sorted(want.select(", ".join(columns)).fetchall()) and rows
