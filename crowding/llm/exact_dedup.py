"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks. Each chunk's polynomial hash is computed for itself,
all chunks of a step at once, and a text's hash is put together from those of
its chunks: appending n bytes shifts the hash by the base to the n-th power and
adds the hash of what is appended. So the cuts don't matter, and a huge text
needs no more memory at once than a few chunks. Four primes of 31 bits make a
fingerprint of 124 bits.

Equal fingerprints prove nothing; their texts are compared. The texts of a
fingerprint stream past that of one leading document, chunk by chunk. Texts
that differ from it go on to another round with a leader among them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _WS, released, stored, text_steps

CHUNK = 1 << 16
MODULI = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1566083941, 715225739, 1103515249, 362437069)
#: Rows and bytes of one fingerprint that one bucket compares.
BUCKET_ROWS, BUCKET_BYTES = 500, 16 << 20

_KEY = ["hi", "lo", "n_bytes"]


def _powers(base: int, p: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < CHUNK:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
    return out


_POWERS = [_powers(b, p) for b, p in zip(BASES, MODULI, strict=True)]


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with each run of white space as one space, and their offsets."""
    if len(data) == 0:
        return data, offsets
    space = _WS[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    begin = offsets[:-1][offsets[:-1] < len(data)]
    keep[begin] = True
    if len(offsets) == 2:
        edge = np.array([0, np.count_nonzero(keep)])
    else:
        edge = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return np.where(space, np.uint8(32), data)[keep], edge


def chunk_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of adjoining chunks, none empty or longer than CHUNK: a row a modulus."""
    body = data[starts[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    at = starts - starts[0]
    power = np.repeat(ends, ends - starts) - 1 - np.arange(starts[0], ends[-1])
    return np.stack(
        [np.add.reduceat(body * _POWERS[i][power], at) % np.uint64(p) for i, p in enumerate(MODULI)]
    )


def joined(left: tuple[int, ...], right: tuple[int, ...], n_right: int) -> tuple[int, ...]:
    """Hash of a text followed by another one of ``n_right`` bytes."""
    return tuple(
        (x * pow(b, n_right, p) + y) % p
        for x, y, p, b in zip(left, right, MODULI, BASES, strict=True)
    )


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of the texts between offsets: a row a modulus. Empty texts have zeros."""
    size = np.diff(offsets)
    many = -(-size // CHUNK)
    doc = np.repeat(np.arange(len(size)), many)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    starts = offsets[:-1][doc] + number * CHUNK
    ends = np.minimum(starts + CHUNK, offsets[1:][doc])
    out = np.zeros((len(MODULI), len(size)), np.uint64)
    lo = 0
    while lo < len(doc):  # about 16 chunks' bytes at a time
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 16 * CHUNK, side="right")))
        h = chunk_hashes(data, starts[lo:hi], ends[lo:hi])
        single = many[doc[lo:hi]] == 1
        out[:, doc[lo:hi][single]] = h[:, single]
        for i in np.flatnonzero(~single).tolist():
            d = doc[lo + i]
            whole = joined(tuple(map(int, out[:, d])), tuple(map(int, h[:, i])), int(ends[lo + i] - starts[lo + i]))
            out[:, d] = whole
        lo = hi
    return out


def _packed(h: np.ndarray, key_bits: int) -> tuple[pa.Array, pa.Array]:
    mask = np.uint64((1 << key_bits) - 1)
    return tuple(
        pa.array((((h[i] << np.uint64(31)) | h[i + 1]) & mask).view(np.int64)) for i in (0, 2)
    )


def _narrow(key_bits: int):
    names = ["doc_id", *_KEY, "text_sha256"]
    schema = pa.schema([(n, pa.string() if n == "text_sha256" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_steps(batch.column(1)):
                data, offsets = normalised(data, offsets)
                n = len(offsets) - 1
                body = memoryview(np.ascontiguousarray(data))
                sha = [hashlib.sha256(body[x:y]).hexdigest() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                hi, lo = _packed(fingerprints(data, offsets), key_bits)
                cols = [batch.column(0).slice(row, n), hi, lo, pa.array(np.diff(offsets)), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return released(run), "doc_id long, hi long, lo long, n_bytes long, text_sha256 string"


def _with_body(key_bits: int):
    names = ["doc_id", *_KEY, "body"]
    schema = pa.schema([(n, pa.large_binary() if n == "body" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_steps(batch.column(1)):
                data, offsets = normalised(data, offsets)
                n = len(offsets) - 1
                hi, lo = _packed(fingerprints(data, offsets), key_bits)
                body = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                )
                cols = [batch.column(0).slice(row, n), hi, lo, pa.array(np.diff(offsets)), body]
                # JVM-side strings and binaries are those of 32-bit offsets.
                cols[-1] = cols[-1].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return released(run), "doc_id long, hi long, lo long, n_bytes long, body binary"


def same_bytes(a: np.ndarray, b: np.ndarray) -> bool:
    """Chunkwise comparison that ends at the first chunk that differs."""
    if len(a) != len(b):
        return False
    return all(np.array_equal(a[x : x + CHUNK], b[x : x + CHUNK]) for x in range(0, len(a), CHUNK))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, its leader first: the others, and if they equal it."""
    bucket, leader = None, None
    for batch in batches:
        col = {n: batch.column(n) for n in batch.schema.names}
        body = col["body"].cast(pa.large_binary())
        _, off, data = body.buffers()
        off = np.frombuffer(off, np.int64)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        places = list(zip(*(col[n].to_pylist() for n in (*_KEY, "salt")), strict=True))
        leads = col["lead"].to_pylist()
        same = []
        for i, (place, lead) in enumerate(zip(places, leads, strict=True)):
            text = data[off[i] : off[i + 1]]
            if lead:
                bucket, leader = place, text.copy()
            elif place != bucket:
                raise RuntimeError("a bucket without its leader")
            same.append(lead or same_bytes(leader, text))
        rest = pa.array([not x for x in leads], pa.bool_())
        equal = pa.array(same, pa.bool_())
        cols = [col[n] for n in ("doc_id", "row", *_KEY, "text_sha256")]
        cols += [equal, pa.array([None if s else x.as_py() for s, x in zip(same, col["body"], strict=True)], pa.binary())]
        out = pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", *_KEY, "text_sha256", "same", "body"])
        yield out.filter(rest)


def _round(members: DataFrame) -> DataFrame:
    """Compare the members of each fingerprint with its leader, in buckets."""
    copies = F.greatest(
        F.ceil(F.col("n") / BUCKET_ROWS), F.ceil(F.col("n") * F.col("n_bytes") / BUCKET_BYTES), F.lit(1)
    ).cast("long")
    # One text a fingerprint: rows that repeat the first id are combined first.
    leaders = (
        members.where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy(*_KEY)
        .agg(F.min("body").alias("body"), F.max("n").alias("n"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
        .select(*_KEY, "salt", F.lit(True).alias("lead"), "body", *(F.lit(None).cast("long").alias(x) for x in ("doc_id", "row")), F.lit(None).cast("string").alias("text_sha256"))
    )
    rest = members.select(
        *_KEY, F.pmod(F.xxhash64("row"), copies).alias("salt"), F.lit(False).alias("lead"),
        "body", "doc_id", "row", "text_sha256",
    )
    both = leaders.unionByName(rest).repartition(*_KEY, "salt")
    return both.sortWithinPartitions(*_KEY, "salt", F.desc("lead")).mapInArrow(
        released(_compared),
        "doc_id long, row long, hi long, lo long, n_bytes long, text_sha256 string, same boolean, body binary",
    )


def _groups(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return rows.groupBy(*_KEY).agg(F.count("*").alias("n"), first["doc_id"].alias("first_id"))


def exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 62
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when their bytes are, each run of the white space characters
    ``[\\x20\\x09-\\x0D]`` as one space; null counts as empty. Of equal texts the row
    with the smallest doc_id stays (nulls last); where several rows have this
    id, one of them. ``text_sha256`` and ``n_bytes`` are those of the normalised
    text. Repeated rows are rows of their own; an empty table gives an empty
    result; other columns are not read. ``key_bits`` is the length of each half
    of a fingerprint: fewer bits mean more comparisons and rounds, not other
    results.
    """
    if not 1 <= key_bits <= 62:
        raise ValueError("1 to 62 bits")
    text = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    rows = stored(
        text.mapInArrow(*_narrow(key_bits)).withColumn("row", F.monotonically_increasing_id()), "exact-rows"
    )
    groups = stored(_groups(rows).where("n > 1"), "exact-groups")
    done = ["doc_id", "row", *_KEY, "text_sha256"]
    alone = rows.join(groups, _KEY, "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "n_bytes",
    )
    members = stored(
        text.mapInArrow(*_with_body(key_bits)).join(groups, _KEY)
        .withColumn("text_sha256", F.sha2("body", 256)).withColumn("row", F.monotonically_increasing_id()),
        "exact-members",
    )
    equal, number = None, 0
    while True:
        found = stored(_round(members), "exact-compared")
        mine = found.where("same").select(*done, F.lit(number).alias("round"))
        equal = mine if equal is None else equal.unionByName(mine)
        left = found.where("not same").drop("same")
        if left.isEmpty():
            break
        members, number = left.join(_groups(left), _KEY), number + 1
    classes = equal.groupBy(*_KEY, "round").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
    )
    classed = equal.join(classes, [*_KEY, "round"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256", "n_bytes",
    )
    return alone.unionByName(classed)
