"""Alignment of two tokenizers against brute force."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from crowding.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Tokens by the libraries, groups by sets of ends, links by testing every pair of spans near each other."""
    ta, tb = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    entry = {i: k for k, i in json.load(open(A))["model"]["vocab"].items()}
    # A token's byte string comes from the library's own decoder, byte by byte of the alphabet.
    alphabet = alignment.byte_level_bytes()

    def piece(i):
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()

    def spans(parts):
        at, out = 0, []
        for x in parts:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    docs, total = [], Counter()
    for i, text in rows:
        a = b = []
        if text:
            a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
            xa, xb = [bytes(alphabet[c] for c in entry[t]) for t in a], [piece(t) for t in b]
            if not b"".join(xa) == b"".join(xb) == (" " + text).encode():
                a = b = []
        if not a:
            docs.append((i, 0, 0, 0, [], ""))
            continue
        sa, sb = spans(xa), spans(xb)
        shared = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for e in shared:
            parts = [[str(t) for t, (x, y) in zip(ids, s, strict=True) if low <= x and y <= e] for ids, s in ((a, sa), (b, sb))]
            groups.append("|".join(",".join(p) for p in parts))
            low = e
        links = [(s, t) for s, (x, y) in zip(a, sa, strict=True) for t, (u, v) in zip(b, sb, strict=True) if x < v and u < y]
        total.update(links)
        docs.append((i, len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, t), c in total.items():
        most[t] = max(most[t], c)
    return [
        (i, n, m, g, len(links), sum(total[x] == most[x[1]] for x in links), sum(total[x] for x in links), digest)
        for i, n, m, g, links, digest in docs
    ]


SHORT = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces  "), (5, "a▁b"), (6, "a<|endoftext|>b <s> </s> <unk> <0x41>"),
    (7, "日本語 テキスト\n\n\ttabs\r\n and naïve Ünïcode 🙂🙂"), (8, "nul \0 bytes\0"), (9, "x" * 700 + " " + "ab" * 400),
    (10, "the cat sat on the mat. the cat sat."), (11, "the cat sat on the mat. the cat sat."), (10, "the cat"),
    (None, "no id"), (None, None), (12, "é ﬁ     ﻿ ​"), (13, "▁"), (14, "\n"), (15, "don't I'll we've"),
]


def result(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in alignment.alignment(df, A, B).collect()), key=str)


def test_equals_brute_force(spark, small_docs):
    rows = SHORT + [(r.doc_id, r.text) for r in small_docs.orderBy("doc_id").collect() if len(r.text or "") < 4000][:60]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS row", "'y' AS pair").repartition(3)
    assert result(df) == sorted(brute(rows), key=str)


def test_edge_rows(spark, edge, nothing):
    got = result(edge)
    assert len(got) == edge.count() and result(nothing) == []
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:] == by_id[2][1:] == (0, 0, 0, 0, 0, 0, "")
    # Interval partitions: a link for every end that either side has.
    assert all(r[4] == r[1] + r[2] - r[3] and r[5] <= r[4] <= r[6] for r in got)
    assert by_id[6][1] > 10_000


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner(alignment.ByteLevelTokens(A), alignment.PieceTokens(B))


def test_windows_are_kept_under_their_ids(own, monkeypatch):
    text = "again and again and again"
    first = own.texts([text])
    calls = []
    monkeypatch.setattr(alignment, "align", lambda *x: calls.append(x))
    assert not calls and own.texts([text, text])[1][:5] == first[0][:5]


def test_small_memory_gives_the_same(own, monkeypatch):
    texts = [t for _, t in SHORT if t] * 2
    want = [x[:5] for x in own.texts(texts)]
    monkeypatch.setattr(alignment, "_MEMO_BYTES", 400)
    monkeypatch.setattr(alignment, "_LONG_WINDOW", 3)
    own.new, own.old, own.load = {}, {}, 0
    assert want == [own.texts([t])[0][:5] for t in texts]


def test_fast_path_equals_the_tokenizers_library(own, small_docs):
    assert own.left.plain
    texts = [t for _, t in SHORT if t] + [r.text for r in small_docs.collect() if r.text]
    texts += [" " * 50_000 + "x", "!?" * 20_000, "abcdefgh" * 9_000, "é" * 9_000]
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    assert [x.tolist() for x in own.left.ids(texts)] == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("change", [("model", "ignore_merges", True), ("pre_tokenizer", "add_prefix_space", True)])
def test_other_files_go_to_the_library(tmp_path, change):
    file = json.load(open(A))
    file[change[0]][change[1]] = change[2]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file))
    other = alignment.ByteLevelTokens(str(path))
    assert not other.plain and [x.tolist() for x in other.ids(["a b"])] == [Tokenizer.from_file(str(path)).encode(" a b").ids]
