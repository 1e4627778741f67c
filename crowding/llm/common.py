"""Helpers shared by the operators: lineage cuts, Arrow buffers, word hashes.

Words are maximal runs of bytes other than ASCII white space. All hashes are
unsigned 64-bit and depend on the bytes alone, so they agree between tasks,
retries and runs.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..session import scratch_path

#: Bytes of text that one vectorised step handles at a time; a longer single
#: document is a step of its own.
STEP_BYTES = 1 << 20

#: A writer keeps a row group of so many bytes in an executor's heap.
BLOCK_BYTES = 32 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[9, 10, 11, 12, 13, 32]] = True

_MUL = 0x9E3779B97F4A7C15
_SHINGLE_MUL = np.uint64(0xD6E8FEB86659FD93)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared store and read it back.

    Cuts the lineage: what follows survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("parquet.block.size", BLOCK_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(run: Callable) -> Callable:
    """A task of ``mapInArrow`` that returns its worker's free memory at its end.

    Workers are used again by later tasks and stages; what an earlier one
    needed would otherwise count against the executor until the session ends.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # C libraries without it
                ctypes.CDLL(None).malloc_trim(0)

    return task


def fmix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 over an unsigned array."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_BYTE = fmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MUL))
_POW = np.cumprod(np.full(256, _MUL, dtype=np.uint64))


def _powers(n: int) -> np.ndarray:
    """At least ``n`` powers of the odd multiplier; long ones are not kept."""
    if n <= len(_POW):
        return _POW
    return np.cumprod(np.full(n, _MUL, dtype=np.uint64))


def text_steps(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into steps of about ``STEP_BYTES``.

    Yields (first row, bytes, offsets); nulls count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        lo, hi = offsets[first], offsets[last]
        yield first, raw[lo:hi], offsets[first : last + 1] - lo
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of its first word per document.

    The third array has one more entry than there are documents.
    """
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    solid = ~_WS[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    begin[cut] = solid[cut]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | begin[1:]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    body = data[starts[0] : ends[-1]]
    at = starts - starts[0]
    span = np.diff(np.append(at, len(body)))
    longest = int((ends - starts).max())
    power = _powers(longest + 1)
    place = np.arange(len(body)) - np.repeat(at, span)
    np.minimum(place, longest, out=place)
    value = _BYTE[body] * power[place]
    value[_WS[body]] = 0
    return fmix(np.add.reduceat(value, at) + (ends - starts).astype(np.uint64))


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words, and their first index per document.

    A document of 1 to k-1 words has one shingle, the whole of it; one without
    words has none.
    """
    count = np.diff(first)
    short = (count > 0) & (count < k)
    made = np.where(count >= k, count - k + 1, short.astype(np.int64))
    index = np.zeros(len(count) + 1, np.int64)
    np.cumsum(made, out=index[1:])
    if len(h) == 0 or index[-1] == 0:
        return np.zeros(0, np.uint64), index
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    runs = np.zeros(len(h), np.uint64)
    for i in range(k):
        runs *= _SHINGLE_MUL
        runs += padded[i : i + len(h)]
    position = np.repeat(first[:-1] - index[:-1], made) + np.arange(index[-1])
    out = runs[position]
    for d in np.flatnonzero(short):
        value = np.uint64(count[d])
        for x in h[first[d] : first[d + 1]]:
            with np.errstate(over="ignore"):
                value = value * _SHINGLE_MUL + x
        out[index[d]] = value
    return fmix(out), index


def as_long(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return h.view(np.int64)


_run_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def run_hashes(h: np.ndarray, at: np.ndarray, length: int, mul: int) -> np.ndarray:
    """Hash of the ``length`` entries of ``h`` from each position in ``at``.

    ``mul`` is odd; equal runs have equal hashes wherever they stand.
    """
    n = len(h) + 1
    if mul not in _run_powers or len(_run_powers[mul][0]) < n:
        both = tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 1 << 16), x, np.uint64)]), dtype=np.uint64)
            for x in (mul, pow(mul, -1, 1 << 64))
        )
        if n > 1 << 21:
            up, down = both
        else:
            up, down = _run_powers[mul] = both
    else:
        up, down = _run_powers[mul]
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * up[: n - 1], dtype=np.uint64)])
    return fmix((total[at + length] - total[at]) * down[at])
