"""Byte-level BPE against tiktoken; packing against the tokenizers library."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crowding.llm import bpe, packing, pretokens

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "\n", "\t", "'s", "'", "1", "é", "\xa0", " ", "日", "!", ".", "  ", "\x1c", "\x85", "<|endoftext|>", "ß", "²", "_", "\r\n", "\0", "the", "ing"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def texts():
    rng = random.Random(7)
    some = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    return [*some, "a" * 5000, "ab" * 3000, " " * 3000, "=-" * 1000, "x" + "\n" * 500, ""]


def test_ids_equal_tiktoken(reference):
    v = bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    for t, got in zip(texts(), v.encode(texts()), strict=True):
        assert np.frombuffer(got, "<i4").tolist() == reference.encode_ordinary(t), repr(t)


def test_a_small_cache_changes_nothing(reference):
    v = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    v.ids_of.size = 300
    for _ in range(2):
        for t in texts()[:300]:
            assert np.frombuffer(v.encode([t])[0], "<i4").tolist() == reference.encode_ordinary(t)


def test_chunks_make_up_the_text():
    for t in texts():
        assert "".join(map(pretokens.chunk, pretokens.keys(t))) == t


def test_library_ids(tokenizer):
    for t, got in zip(texts(), packing.token_ids(texts(), JSON), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_encode_and_decode_edge_rows(edge, nothing, reference):
    out = bpe.decode(bpe.encode(edge, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    got = sorted(((r["doc_id"] or 0, list(r["ids"]), bytes(r["bytes"])) for r in out.collect()), key=repr)
    want = [(r["doc_id"] or 0, r["text"] or "") for r in edge.collect()]
    assert got == sorted(((i, reference.encode_ordinary(t), t.encode()) for i, t in want), key=repr)
    assert bpe.decode(bpe.encode(nothing, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


SPECIAL = "<|endoftext|>"


def test_special_tokens_are_the_librarys(tokenizer):
    some = [f"a{SPECIAL}b", SPECIAL, f"{SPECIAL}{SPECIAL}", f"one two{SPECIAL}\nthree {SPECIAL} four", f"x  {SPECIAL}  y",
            f"word{SPECIAL}.", f"word{SPECIAL[:-1]} >", f"line\n{SPECIAL}\n\nline", SPECIAL.replace("of", " of"), f"\0{SPECIAL}"]
    assert 50256 in tokenizer.encode(some[0], add_special_tokens=False).ids
    for t, got in zip(some, packing.token_ids(some, JSON), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def packed(lengths, capacity):
    bins, rows, at = packing._Bins(capacity, 0), [], 0
    for i, n in enumerate(lengths):
        rows += bins.add(i, np.arange(at, at + n, dtype="<u4").tobytes())
        at += n
    bound = len(rows)
    return rows + list(bins.rest()), bound


@pytest.mark.parametrize("capacity", [1, 2, 8, 64, 1024])
def test_bins_hold_their_classes_number(capacity):
    rng = random.Random(capacity)
    lengths = [max(1, int(rng.paretovariate(0.7) * capacity / 9)) % (9 * capacity) + 1 for _ in range(3000)]
    rows, bound = packed(lengths, capacity)
    by, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
        sequences[row[5]].append(row)
    first = 0
    for i, n in enumerate(lengths):
        parts = sorted(by[i], key=lambda x: x[1])
        ids = np.concatenate([np.frombuffer(p[3], "<u4") for p in parts])
        assert ids.tolist() == list(range(first, first + n)) and all(p[4] == n for p in parts)
        assert [p[1] for p in parts] == np.cumsum([0, *(p[2] for p in parts[:-1])]).tolist()
        first += n
    assert sorted(sequences) == list(range(len(sequences)))
    full = {row[5] for row in rows[:bound]}
    for s, parts in sequences.items():
        assert [p[6] for p in parts] == np.cumsum([0, *(p[2] for p in parts[:-1])]).tolist()
        size = sum(p[2] for p in parts)
        assert size == capacity or (s not in full and size < capacity and size & (size - 1) == 0)
        if s in full and parts[0][2] < capacity:
            # k whole remainders of class k, then pieces of fillers.
            k = packing.harmonic_class(parts[0][2], capacity)
            whole = [p for p in parts if p[1] + p[2] == p[4] and p[2] == p[4] % capacity]
            assert len(whole) >= k
            assert all(packing.harmonic_class(p[2], capacity) == k for p in parts[:k])
    # Every bin cuts one filler at most, and a task's end few.
    assert len(rows) <= sum(-(-n // capacity) for n in lengths) + len(sequences) + 12


def test_packing_edge_rows(edge, nothing, tokenizer):
    rows = packing.pack_documents(edge, JSON).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 1024 or at & (at - 1) == 0  # no padding at all
    for r in edge.where("doc_id <> 7 and doc_id is not null").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert zlib.crc32(bytes(p["ids"])) == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    assert sum(p["length"] for p in by[7]) == 3 * by[7][0]["doc_tokens"]  # repeated rows stay
    assert packing.pack_documents(nothing, JSON).count() == 0
    # The same partitions give the same sequences again.
    again = packing.pack_documents(edge, JSON).select(F.hash("*")).collect()
    assert sorted(again) == sorted(packing.pack_documents(edge, JSON).select(F.hash("*")).collect())
    with pytest.raises(ValueError):
        packing.pack_documents(edge, JSON, capacity=1000)
