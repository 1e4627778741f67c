"""Byte-level BPE with a rank queue over a hierarchical bitmap.

Pre-tokens' bytes are a linked list. Each merge rank has a bucket of list
positions whose pair has that rank; a two-level bitmap of non-empty buckets
gives the lowest rank by find-first-set. Entries whose pair has changed since
are skipped. A merge costs the same however long a pre-token is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .pretokens import ChunkIds, text_groups

_GROUP_CHARS = 2_000_000
_CACHE_CHARS = 75_000_000


#: One bit of a bitmap word; words and their directory have 256 bits.
_BIT = [1 << i for i in range(256)]
#: Pre-tokens that share a queue; they bound its memory.
_TOGETHER = 20_000


class Vocabulary:
    """Ranks of a tiktoken file, below 2**16; encodes pre-tokens and decodes ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(self.ranks.values()) >= 1 << 16:
            raise ValueError("the bitmap holds ranks below 65536")
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)])
        rank_of = self.ranks.get
        #: Rank of two neighbouring ids, where their bytes together have one.
        self.merges = {
            x << 16 | y: r
            for k, r in self.ranks.items()
            for i in range(1, len(k))
            if (x := rank_of(k[:i])) is not None and (y := rank_of(k[i:])) is not None
        }
        self.byte_pairs = np.array(
            [[self.merges.get(x << 16 | y, -1) for y in self.byte_ids.tolist()] for x in self.byte_ids.tolist()]
        )
        self.pattern = regex.compile(pattern)
        self.ids_of = ChunkIds(self._chunks, _CACHE_CHARS)

    def pre_tokens(self, many: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens that aren't tokens themselves, and how many each has.

        They lie behind each other in one list and share one queue: merges
        never cross their borders, so each one's go in its own order of rank,
        then place. ``words`` has the bitmap words of ranks, ``top`` the
        directory of words that aren't zero, ``buckets`` each rank's positions.
        """
        data = np.frombuffer(b"".join(many), np.uint8)
        size = np.array([len(x) for x in many])
        first = np.cumsum(size) - size
        last = first + size - 1
        after = np.arange(1, len(data) + 1)
        after[last] = -1
        before = np.arange(-1, len(data) - 1)
        before[first] = -1
        rank = np.append(self.byte_pairs[data[:-1], data[1:]], -1)
        rank[last] = -1
        tokens, after, before, pair = (x.tolist() for x in (self.byte_ids[data], after, before, rank))

        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        found, cut = np.unique(rank[at], return_index=True)
        buckets = dict(zip(found.tolist(), (x.tolist() for x in np.split(at, cut[1:])), strict=False))
        top, words, bit = 0, {}, _BIT

        def push(r: int, i: int) -> None:
            nonlocal top
            if r in buckets:
                buckets[r].append(i)
                return
            buckets[r] = [i]
            a = r >> 8
            words[a] = words.get(a, 0) | bit[r & 255]
            top |= bit[a]

        for r in buckets:
            words[r >> 8] = words.get(r >> 8, 0) | bit[r & 255]
            top |= bit[r >> 8]
        rank_of = self.merges.get
        while top:
            a = (top & -top).bit_length() - 1  # find first set, twice
            word = words[a]
            r = a << 8 | (word & -word).bit_length() - 1
            bucket = buckets.pop(r)
            words[a] = word & (word - 1)
            if not words[a]:
                top &= top - 1
            if len(bucket) > 1:
                bucket.sort()
            for done, i in enumerate(bucket, 1):
                if pair[i] != r:
                    continue  # stale: the pair has changed since
                middle = after[i]
                end = after[middle]
                tokens[i], tokens[middle] = r, -1
                after[i] = end
                pair[middle] = p = q = -1
                if end >= 0:
                    before[end] = i
                    p = rank_of(r << 16 | tokens[end], -1)
                    if p in buckets:
                        buckets[p].append(i)
                    elif p >= 0:
                        push(p, i)
                pair[i] = p
                j = before[i]
                if j >= 0:
                    pair[j] = q = rank_of(tokens[j] << 16 | r, -1)
                    if q in buckets:
                        buckets[q].append(j)
                    elif q >= 0:
                        push(q, j)
                if 0 <= p <= r or 0 <= q <= r:
                    # A merge that comes before the rest of this bucket.
                    for x in bucket[done:]:
                        push(r, x)
                    break
        ids = np.array(tokens, dtype="<i4")
        alive = ids >= 0
        return ids[alive], np.add.reduceat(alive, first, dtype=np.int64)

    def _pieces(self, pieces: list[bytes]) -> tuple[bytes, list[int]]:
        """Ids of pre-tokens, as bytes, and where each one's begin and the last's end."""
        rank_of = self.ranks.get
        whole = np.array([rank_of(x, -1) for x in pieces], dtype="<i4")
        count = np.ones(len(pieces), np.int64)
        parts = np.flatnonzero(whole < 0)
        found = []
        for lo in range(0, len(parts), _TOGETHER):
            part = parts[lo : lo + _TOGETHER]
            ids, count[part] = self.pre_tokens([pieces[i] for i in part])
            found.append(ids)
        edge = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(edge[-1], "<i4")
        split = np.repeat(whole < 0, count)
        out[~split] = whole[whole >= 0]
        if found:
            out[split] = np.concatenate(found)
        return out.tobytes(), (4 * edge).tolist()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        pieces, ends = [], [0]
        for c in chunks:
            if c.removeprefix(" ").isalpha():
                pieces.append(c.encode("utf-8"))
            else:
                pieces += [x.encode("utf-8") for x in self.pattern.findall(c)]
            ends.append(len(pieces))
        data, at = self._pieces(pieces)
        return [data[at[x] : at[y]] for x, y in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        return self.ids_of.of(texts)

    def decode(self, ids: np.ndarray, edge: np.ndarray) -> pa.Array:
        """Bytes of the ids between each two neighbouring edges."""
        if not hasattr(self, "table"):
            top = max(self.bytes_of) + 1
            self.size = np.array([len(self.bytes_of.get(i, b"")) for i in range(top)], np.int32)
            self.begin = np.cumsum(self.size, dtype=np.int32) - self.size
            self.table = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(top)), np.uint8)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id that the rank file lacks")
        size = self.size[ids]
        end = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = np.arange(end[-1], dtype=np.int32) - np.repeat((end[:-1] - self.begin[ids]).astype(np.int32), size)
        return pa.Array.from_buffers(
            pa.binary(), len(edge) - 1, [None, pa.py_buffer(end[edge].astype(np.int32)), pa.py_buffer(self.table[at])]
        )


_vocabularies: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """This worker's copy of a rank file."""
    key = (path, pattern)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(path, pattern)
    return _vocabularies[key]


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    flat = np.frombuffer(b"".join(parts), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text.

    Each match of ``pattern`` is encoded by itself; there are no special
    tokens. Null and empty texts have no ids. Ids of documents may be null or
    repeat; an empty table gives an empty result; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for batch in batches:
            for first, texts in text_groups(batch.column(1).to_pylist(), _GROUP_CHARS):
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, _lists(v.encode(texts)).cast(schema.types[1])], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for; null ids give no bytes.

    An id that the rank file lacks is an error.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                ids = part.column(1)
                edge = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
                text = v.decode(ids.flatten().to_numpy(zero_copy_only=False), edge.astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), ids.cast(schema.types[1]), text], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
