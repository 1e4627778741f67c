"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is the set of its word shingles. Each shingle is a Poisson process
whose rate is its weight; an arrival falls on one register, which keeps the
shingle of its earliest arrival. Two documents agree on a register with the
probability Jaccard similarity of their weighted sets. Shingles whose next
arrival is later than all of the document's registers stop early. All weights
are 1, however often a shingle occurs: then that similarity is the Jaccard
similarity of the sets, by which a pair is a link.

Documents with the same shingles are one shape. Shapes that agree on a band of
registers share a bucket; candidate pairs come from buckets, and a pair is a
link if the Jaccard similarity of its shingle sets reaches the threshold.
Classes are the connected components. Buckets never emit all their pairs:
members are compared with the most central one, components are formed, and
only buckets that still hold several components go on, to the pairs of
different components that can be links at all. So no link
between two components stays unseen within a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, fmix, released, shingle_hashes, stored, text_steps, word_hashes, words
from .components import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 6
#: Rounds in which members are compared with one leader of their bucket.
LEADERS = 1
#: Buckets that give all pairs of different components, and shingles that are
#: looked up, have at most so many members.
SMALL_BUCKET = 16
RARE = 8

_DOCS_A_STEP = 4000
_ID_BITS = np.uint64(52)
_ID_MASK = np.uint64((1 << 52) - 1)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of at most 4095 documents: document, 52-bit id.

    In ascending order of document and id.
    """
    starts, ends, first = words(data, offsets)
    h, index = shingle_hashes(word_hashes(data, starts, ends), first, k)
    doc = np.repeat(np.arange(len(index) - 1, dtype=np.uint64), np.diff(index))
    key = np.sort(doc << _ID_BITS | h >> np.uint64(12))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key = key[at]
    return (key >> _ID_BITS).astype(np.int64), key & _ID_MASK


def prob_min_hash(doc: np.ndarray, ids: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m registers: the id of each register's earliest arrival (0: none)."""
    earliest = np.full(n * m, np.inf)
    winner = np.zeros(n * m, np.uint64)
    at = np.zeros(len(ids))
    seed = fmix(ids + np.uint64(1))
    latest = np.full(n, np.inf)
    arrival = 0
    while len(ids):
        arrival += 1
        draw = fmix(seed + np.uint64(arrival * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        at = at + gap / weight
        on = at < latest[doc]
        if not on.all():
            doc, ids, weight, at, seed, draw = (x[on] for x in (doc, ids, weight, at, seed, draw))
        place = doc * m + (fmix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, place, at)
        won = earliest[place] == at
        winner[place[won]] = ids[won] + np.uint64(1)
        latest = earliest.reshape(n, m).max(axis=1)
    return winner.reshape(n, m)


def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum modulo 2**64 for each document; ``doc`` ascends."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    edge = np.searchsorted(doc, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]


def _sketcher(k: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("copy", pa.binary()), ("shape", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )
    band_seed = fmix(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _DOCS_A_STEP):
                part = batch.slice(lo, _DOCS_A_STEP)
                for first, data, offsets in text_steps(part.column(1)):
                    n = len(offsets) - 1
                    doc, ids = distinct_shingles(data, offsets, k)
                    size = np.bincount(doc, minlength=n)
                    digest = np.stack([_sums(fmix(ids + np.uint64(c)), doc, n) for c in (1 << 60, 3 << 60)], axis=1)
                    shape = np.ascontiguousarray(digest).tobytes()
                    win = prob_min_hash(doc, ids, np.ones(len(ids)), n, bands * rows)
                    mixed = np.tile(band_seed, (n, 1))
                    for r in range(rows):
                        mixed = fmix(mixed * np.uint64(0x9E3779B97F4A7C15) + win.reshape(n, bands, rows)[:, :, r])
                    width = np.where(size > 0, bands, 0)  # no words, no bands
                    edge = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
                    listed = pa.ListArray.from_arrays(pa.array(edge), pa.array(as_long(mixed[size > 0].ravel())))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).slice(first, n),
                            part.column(2).slice(first, n),
                            pa.array([shape[16 * i : 16 * i + 16] for i in range(n)], pa.binary()),
                            pa.array(size, pa.int64()),
                            listed.cast(schema.types[4]),
                        ],
                        schema=schema,
                    )

    return run


def _shingle_lists(k: int):
    schema = pa.schema([("shape", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                for first, data, offsets in text_steps(part.column(1)):
                    n = len(offsets) - 1
                    doc, ids = distinct_shingles(data, offsets, k)
                    edge = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                    listed = pa.ListArray.from_arrays(pa.array(edge), pa.array(as_long(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(first, n), listed.cast(schema.types[1])], schema=schema
                    )

    return run


def _copy_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _leaders(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs (x, y) of each bucket's leader with its members: at first the most
    central one, that with the largest buckets, then another by hash."""
    first = F.xxhash64("shape", "bucket", F.lit(turn)) if turn > 1 else -F.col("weight")
    order = F.struct(first.alias("o"), "shape", "n", "root")
    lead = rows.groupBy("bucket").agg(F.min(order).alias("l"))
    return rows.join(lead, "bucket").select(
        F.col("l.shape").alias("x"), F.col("l.n").alias("nx"), F.col("l.root").alias("rx"),
        F.col("shape").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"),
    )


def _pairs(rows: DataFrame, on: Column | None = None) -> DataFrame:
    """Pairs of a bucket's members of different components."""
    x, y = rows.alias("x"), rows.alias("y")
    both = (
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.shape") < F.col("y.shape"))
        & (F.col("x.root") != F.col("y.root"))
    )
    return x.join(y, both if on is None else both & on).selectExpr(*_PAIR)


_PAIR = [f"{s}.{c} AS {name}{s}" for s in "xy" for c, name in (("shape", ""), ("n", "n"), ("root", "r"))]


def _remaining(rows: DataFrame, sets: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that share a bucket and may be links.

    Small buckets give all of them. In large ones, two shapes that share no
    rare shingle (one that at most RARE of these shapes have) share at most
    what is left of each without its rare ones, which rules out most pairs
    inside the join; pairs that share one come from its short list of shapes.
    A pair that shares several buckets comes from the first of them.
    """
    small = rows.where(F.col("size") <= SMALL_BUCKET)
    large = rows.where(F.col("size") > SMALL_BUCKET)
    shapes = large.select("shape", "n", "root").distinct()
    ids = sets.join(shapes, "shape").select("shape", "n", "root", F.explode("ids").alias("id"))
    rare = stored(ids.join(ids.groupBy("id").agg(F.count("*").alias("c")).where(F.col("c") <= RARE), "id"), "rare")
    member = F.struct("shape", "n", "root")
    listed = rare.where("c > 1").groupBy("id").agg(F.collect_list(member).alias("l"))
    crossed = F.flatten(F.transform("l", lambda x: F.transform("l", lambda y: F.struct(x.alias("x"), y.alias("y")))))
    crossed = F.filter(crossed, lambda p: (p["x"]["shape"] < p["y"]["shape"]) & (p["x"]["root"] != p["y"]["root"]))
    sharing = listed.select(F.explode(crossed).alias("p")).select("p.x", "p.y").selectExpr(*_PAIR)
    kept = large.join(rare.groupBy("shape").agg(F.count("*").alias("rare")), "shape", "left").withColumn(
        "open", F.col("n") - F.coalesce("rare", F.lit(0))
    )
    kept = kept.where(F.col("open") >= F.col("n") * F.lit(threshold - 1e-9)).join(bands, "shape")
    most = F.least("x.open", "y.open")
    bound = most >= (F.col("x.n") + F.col("y.n") - most) * F.lit(threshold - 1e-9)
    bound = bound & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket"))
    return _pairs(small).unionByName(sharing).unionByName(_pairs(kept, bound))


def _sizes_fit(a: Column, b: Column, threshold: float) -> Column:
    """Whether sets of these sizes can reach the threshold at all."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(threshold - 1e-9)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_a_shingle: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Class of every document: doc_id, copy, class_id, class_size, keeps.

    ``class_id`` is the smallest doc_id of the class (null if all are null),
    ``copy`` the MD5 of the text. ``keeps`` holds for the row that stays for
    its class: the smallest (doc_id, copy), nulls last; rows that repeat both
    all have it. Shingles are runs of ``words_a_shingle`` words; a shorter text
    is one shingle. Null, empty and blank texts have no shingles and are one
    class. A pair at the threshold misses all bands with probability
    (1 - threshold**rows)**bands, 6e-5 by default, more similar ones less,
    whatever the counts of their shingles.
    An empty table gives an empty result; other columns are not read.
    """
    k = words_a_shingle
    text = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _copy_key(F.col(text_col)).alias("copy")
    )
    sketches = stored(
        text.mapInArrow(
            released(_sketcher(k, bands, rows)), "doc_id long, copy binary, shape binary, n long, bands array<long>"
        ),
        "sketches",
    )
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "copy", "n", "bands"))
    shapes = stored(
        sketches.groupBy("shape")
        .agg(one.alias("one"), F.count("*").alias("docs"))
        .select("shape", "docs", F.struct("one.no_id", "one.doc_id", "one.copy").alias("first"), "one.n", "one.bands"),
        "shapes",
    )
    spread = shapes.select("shape", "n", F.explode("bands").alias("bucket"))
    # Written, so that the planner knows its size when it joins it.
    shared = stored(spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = stored(spread.join(shared, "bucket"), "buckets")
    weight = members.groupBy("shape").agg(F.sum("size").alias("weight"))
    members = stored(
        members.join(weight, "shape").select("bucket", "size", "shape", "n", "weight", F.col("shape").alias("root")), "buckets"
    )
    keys = stored(weight.select("shape"), "candidates")
    # One text per candidate shape, found again by its row's id and MD5.
    wanted = shapes.join(keys, "shape", "left_semi").select("shape", "first")
    row = (F.col("copy") == F.col("first.copy")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    sets = stored(
        text.join(wanted, row).select("shape", "text").dropDuplicates(["shape"])
        .mapInArrow(released(_shingle_lists(k)), "shape binary, ids array<long>"),
        "shingles",
    )

    left, links, tested, roots = members, None, None, None
    for turn in range(1, LEADERS + 2):
        if turn > 1:
            now = members.drop("root").join(
                roots.select(F.col("node").alias("shape"), "root"), "shape", "left"
            ).withColumn("root", F.coalesce("root", "shape"))
            now = stored(now, "rooted")
            mixed = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
            left = stored(now.join(mixed.select("bucket"), "bucket", "left_semi"), "mixed")
        raw = _leaders(left, turn) if turn <= LEADERS else _remaining(left, sets, shapes.select("shape", "bands"), threshold)
        raw = raw.where((F.col("rx") != F.col("ry")) & _sizes_fit(F.col("nx"), F.col("ny"), threshold))
        pairs = raw.select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
            F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"),
            F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb"),
        ).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        both = F.size(F.array_intersect("ids_a", "ids_b"))
        checked = stored(
            pairs.join(sets.select(F.col("shape").alias("a"), F.col("ids").alias("ids_a")), "a")
            .join(sets.select(F.col("shape").alias("b"), F.col("ids").alias("ids_b")), "b")
            .select("a", "b", (both >= threshold * (F.col("na") + F.col("nb") - both) - 1e-9).alias("near")),
            "checked",
        )
        found = checked.where("near").select("a", "b")
        links = found if links is None else links.unionByName(found)
        tested = checked.select("a", "b") if tested is None else tested.unionByName(checked.select("a", "b"))
        roots = components(links, "a", "b")

    named = shapes.select("shape", "first", "docs").join(
        roots.select(F.col("node").alias("shape"), "root"), "shape", "left"
    )
    named = named.withColumn("root", F.coalesce("root", "shape"))
    classes = named.groupBy("root").agg(F.min("first").alias("keep"), F.sum("docs").alias("class_size"))
    by_shape = named.select("shape", "root").join(classes, "root").select("shape", "keep", "class_size")
    keeps = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("copy") == F.col("keep.copy"))
    return sketches.select("doc_id", "copy", "shape").join(by_shape, "shape").select(
        "doc_id", "copy", F.col("keep.doc_id").alias("class_id"), "class_size", keeps.alias("keeps")
    )


def one_of_each(docs: DataFrame, classes: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one for each class, all columns.

    ``classes`` is the result of ``near_duplicates`` on the same rows. The
    texts of rows that stay move only where the list of the others is too
    large to broadcast.
    """
    classes = stored(classes, "classes")
    key = [F.col("doc_id"), F.col("copy")]
    gone = classes.where(~F.col("keeps")).select(*key)
    again = classes.where("keeps").groupBy(*key).count().where(F.col("count") > 1).select(*key)
    row_id, row_copy = docs[id_col].cast("long"), _copy_key(docs[text_col])

    other = gone.unionByName(again).withColumnRenamed("doc_id", "__gone_id").withColumnRenamed("copy", "__gone_copy")
    stay = docs.join(
        other, (F.col("__gone_copy") == row_copy) & F.col("__gone_id").eqNullSafe(row_id), "left_anti"
    )
    twice = again.withColumnRenamed("doc_id", "__again_id").withColumnRenamed("copy", "__again_copy")
    doubled = docs.join(
        twice, (F.col("__again_copy") == row_copy) & F.col("__again_id").eqNullSafe(row_id), "left_semi"
    )
    return stay.unionByName(doubled.dropDuplicates([id_col, text_col]))
