"""Harmonic packing of token ids into sequences of a fixed capacity.

A document's full sequences are cut off first; what remains, r ids, falls into
the reciprocal class k = capacity // r: k such remainders fit a bin, and a bin
of class k holds exactly k of them. Each task fills the bins of its own rows,
without a shuffle. What a full bin lacks is cut from a filler, a remainder that
came while there was none, so bins have no padding and only fillers are cut.
At a task's end the bins that aren't full are laid end to end and cut into
sequences; the last ids of the task become sequences of powers of two, which
are not padded either.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .alignment import ByteLevelTokens
from .common import released
from .pretokens import text_groups

CAPACITY = 1024
END_ID = 0
#: Classes of remainders; smaller ones share the last.
CLASSES = 32
_GROUP_CHARS = 500_000
_OUT_BYTES = 8_000_000
_SEQUENCES_A_TASK = 1 << 33

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_ARROW = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in (x.split()[0] for x in SCHEMA.split(", "))]
)

_encoders: dict[str, Callable[[list[str]], list[bytes]]] = {}


def _encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Ids as the tokenizers library gives them for the file, without special tokens added.

    The library itself encodes texts that hold a special token's string, which
    is that token wherever it stands, and all texts where the file is more than
    byte-level BPE; for the others see ``ByteLevelTokens``.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own, library = ByteLevelTokens(path), Tokenizer.from_file(path)
    added = [t.content for t in library.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> list[bytes]:
        plain = [own.plain and not any(x in t for x in added) for t in texts]
        fast = iter(own.encode([t for t, p in zip(texts, plain, strict=True) if p]))
        slow = iter(library.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        ids = [next(fast) if p else next(slow).ids for p in plain]
        return [np.asarray(x, dtype="<u4").tobytes() for x in ids]

    return encode


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    if path not in _encoders:
        _encoders[path] = _encoder(path)
    return _encoders[path](texts)


def harmonic_class(r: int, capacity: int) -> int:
    """How many remainders of r ids a bin holds: capacity / (k + 1) < r <= capacity / k."""
    return min(capacity // r, CLASSES)


class _Bins:
    """Open bins of one task. A piece is [doc id, start, ids as bytes, document's ids]."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[list]] = {}
        self.filler: list | None = None
        self.lacking: list[list] = []

    def _sequence(self, pieces: list[list]) -> Iterator[tuple]:
        at = 0
        for doc_id, start, data, n in pieces:
            size = len(data) // 4
            yield doc_id, start, size, data, n, self.next, at
            at += size
        self.next += 1

    @staticmethod
    def _cut(piece: list, size: int) -> tuple[list, list | None]:
        """The first ``size`` ids of a piece, and what is left of it."""
        doc_id, start, data, n = piece
        rest = [doc_id, start + size, data[4 * size :], n] if len(data) > 4 * size else None
        return [doc_id, start, data[: 4 * size], n], rest

    def _fill(self, pieces: list[list]) -> Iterator[tuple]:
        """Close a bin, its gap filled; without enough filler it waits for the next one."""
        gap = self.capacity - sum(len(p[2]) for p in pieces) // 4
        if gap and self.filler:
            part, self.filler = self._cut(self.filler, gap)
            pieces = [*pieces, part]
            gap -= len(part[2]) // 4
        if gap:
            self.lacking = pieces
        else:
            self.lacking = []
            yield from self._sequence(pieces)

    def add(self, doc_id, data: bytes) -> Iterator[tuple]:
        n, whole = len(data) // 4, self.capacity
        for start in range(0, n - n % whole, whole):
            yield from self._sequence([[doc_id, start, data[4 * start : 4 * (start + whole)], n]])
        r = n % whole
        if not r:
            return
        piece = [doc_id, n - r, data[4 * (n - r) :], n]
        if not self.filler:
            self.filler = piece
            if self.lacking:
                yield from self._fill(self.lacking)
            return
        k = harmonic_class(r, whole)
        mine = self.open.setdefault(k, [])
        mine.append(piece)
        if len(mine) == k:
            self.open[k] = []
            yield from self._fill(mine)

    def rest(self) -> Iterator[tuple]:
        """What is left at the end: laid end to end, cut at the capacity, then at powers of two."""
        left = self.lacking + [p for k in sorted(self.open) for p in self.open[k]] + ([self.filler] if self.filler else [])
        total = sum(len(p[2]) for p in left) // 4
        while total:
            size = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
            total -= size
            pieces = []
            while size:
                part, rest = self._cut(left.pop(0), size)
                pieces.append(part)
                size -= len(part[2]) // 4
                if rest:
                    left.insert(0, rest)
            yield from self._sequence(pieces)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents, packed: one row per piece.

    doc_id, start (ids of the document before it), length, ids (little-endian
    unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset in the
    sequence. A document's ids are its text's, then ``end_id``; a null or empty
    text has the end id alone. ``capacity`` is a power of two; sequences are
    full, or hold a power of two. Null and repeated ids are documents of their
    own; an empty table gives an empty result; other columns are not read.
    Special tokens' strings in a text are encoded as the tokenizer file has it.
    A task's sequence numbers begin at its partition's, so a task that runs
    again makes the same rows.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins(capacity, TaskContext.get().partitionId() * _SEQUENCES_A_TASK)
        rows: list[tuple] = []

        def made() -> pa.RecordBatch:
            out = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, schema=_ARROW)

        load = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in text_groups(batch.column(1).to_pylist(), _GROUP_CHARS):
                for i, found in enumerate(token_ids(texts, tokenizer_path), first):
                    rows.extend(bins.add(ids[i], found + end))
                    load += len(found)
                    if load > _OUT_BYTES and rows:
                        yield made()
                        load = 0
        rows.extend(bins.rest())
        if rows:
            yield made()

    return docs.select(
        docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")
    ).mapInArrow(released(run), SCHEMA)
