"""Exact duplicates: fingerprints, comparison and the whole against brute force."""

import hashlib
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from crowding.llm import exact_dedup, oracle, queries

from .conftest import LONG

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Multiset of (doc_id, keep_id, size, sha256) and the number kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(rb"[\x20\x09-\x0D]+", b" ", (t or "").encode())].append(i)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None, len(ids), hashlib.sha256(body).hexdigest()) for i in ids]
    return sorted(out, key=str), len(groups)


def check(df, rows, **how):
    got = exact_dedup.exact_duplicates(df, **how).collect()
    want, kept = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == kept
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_edge_rows(spark, edge, nothing):
    check(edge, [(r.doc_id, r.text) for r in edge.collect()])
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def many():
    rows = [(i, f"text {i % 7:02d}") for i in range(300)]
    rows += [(i, f"text{' ' * (i % 5 + 1)}03") for i in range(300, 400)]
    rows += [(5, "text 05")] * 30 + [(None, "text 06")] * 3 + [(None, "nul\0")] * 2
    return rows + [(500, LONG), (501, LONG.replace(" ", "\n\n")), (502, LONG[:-1]), (503, None), (504, "")]


@pytest.mark.parametrize("key_bits", [62, 2, 1])
def test_short_fingerprints_collide_without_harm(spark, monkeypatch, key_bits):
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 10)
    rows = many()
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, key_bits=key_bits)


def test_chunks_compose(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 3 * exact_dedup.CHUNK + 777, np.uint8)
    whole = exact_dedup.fingerprints(data, np.array([0, len(data)]))[:, 0].tolist()
    for cut in (1, 70_000, len(data) - 1):
        a, b = (exact_dedup.fingerprints(x, np.array([0, len(x)]))[:, 0].tolist() for x in (data[:cut], data[cut:]))
        assert list(exact_dedup.joined(tuple(a), tuple(b), len(data) - cut)) == whole
    value = 0
    for x in data[:300].tolist():
        value = (value * exact_dedup.BASES[2] + x + 1) % exact_dedup.MODULI[2]
    assert exact_dedup.fingerprints(data[:300], np.array([0, 0, 300, 300]))[2].tolist() == [0, value, 0]


def test_white_space_runs_end_with_their_text():
    parts = [b" a\t\n", b" ", b"", b"\r\nb  c\x0b", b"\xe2\x80\x83"]
    offsets = np.cumsum([0, *map(len, parts)])
    data, edge = exact_dedup.normalised(np.frombuffer(b"".join(parts), np.uint8), offsets)
    got = [data[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)]
    assert got == [b" a ", b" ", b"", b" b c ", b"\xe2\x80\x83"]


def test_comparison_is_of_every_byte():
    a = np.zeros(3 * exact_dedup.CHUNK + 5, np.uint8)
    b = a.copy()
    assert exact_dedup.same_bytes(a, b) and not exact_dedup.same_bytes(a, b[:-1])
    b[-1] = 1
    assert not exact_dedup.same_bytes(a, b)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(oracle.ORACLE["op12_exact"]).fetchall()
    got = queries.QUERIES["op12_exact"](spark, SF)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
