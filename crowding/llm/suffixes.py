"""Repeated passages by a sparse suffix array.

Only suffixes at content-selected positions are kept: the leftmost smallest
hash of each window of SPREAD k-grams. A passage of MIN_WORDS words holds such
a position among its first SPREAD words, the same wherever it occurs, so its
occurrences have suffixes that agree in their first PREFIX words.

The array is range partitioned and sorted by those words (as one 64-bit hash,
which puts equal prefixes next to each other), then by place, and every suffix
is compared with its neighbours; one that agrees with none goes. The others are
extended: every start up to SPREAD - 1 words to the left, with MIN_WORDS words
to the right, enters a second array, sorted by all those words (as a 128-bit
hash) and then by the order of places. Neighbours that agree are occurrences of
one run, the first of them its source, and chains of runs make a passage's
whole length. A run of neighbours may cross the borders of sorted partitions:
each partition also reports its first and last run, and these few rows settle
what the partition can't see.

Copies of a whole text count once: its suffixes are those of its first
document, and the others are repeated as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_long, fmix, released, run_hashes, stored, text_steps, word_hashes, words

MIN_WORDS = 50
GRAM = 8
SPREAD = 25

_MULS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
#: Two hashes of a text tell it from others.
_COPY = ["copy", "copy2"]
_ARRAY_SCHEMA = "key long, copy long, copy2 long, pos int, lead boolean, doc_id long, n_words int"
#: Sorted rows that a task looks at together.
_SCAN_ROWS = 1 << 16


def _copy_keys(text: Column) -> list[Column]:
    """What copies of a text are told by: 128 bits, of two seeds."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("copy"), F.xxhash64(F.lit(1), text).alias("copy2")]


def minimisers(h: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Selected word positions of the documents that have at least ``least`` words."""
    if len(h) < GRAM + SPREAD - 1:
        return np.zeros(0, np.int64)
    gram = run_hashes(h, np.arange(len(h) - GRAM + 1), GRAM, _MULS[0])
    pick = np.lib.stride_tricks.sliding_window_view(gram, SPREAD).argmin(axis=1) + np.arange(len(gram) - SPREAD + 1)
    size = np.diff(first)
    begin, many = first[:-1][size >= least], size[size >= least] - (GRAM + SPREAD - 2)
    inside = np.zeros(len(pick) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + many, -1)
    return np.unique(pick[np.cumsum(inside[:-1]) > 0])


def _suffixes(least: int):
    prefix = least - SPREAD + 1
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32()]
    schema = pa.schema([(x.split()[0], k) for x, k in zip(_ARRAY_SCHEMA.split(", "), kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_steps(batch.column(1)):
                starts, ends, first = words(data, offsets)
                h = word_hashes(data, starts, ends)
                size = np.diff(first)
                at = minimisers(h, first, least)
                doc = np.searchsorted(first, at, side="right") - 1
                lead = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
                # A suffix shorter than the prefix can't begin a match; a
                # document's first row also carries its id and size.
                fits = at + prefix <= first[doc + 1]
                at, doc, lead = at[fits | lead], doc[fits | lead], lead[fits | lead]
                short = np.minimum(at, np.maximum(first[doc + 1] - prefix, 0))
                key = run_hashes(h, short, prefix, _MULS[1]) if len(at) else np.zeros(0, np.uint64)
                take = pa.array(doc)
                ids, copy, copy2 = (batch.column(i).slice(row, len(size)).take(take) for i in (0, 2, 3))
                pos, n_words = pa.array((at - first[doc]).astype(np.int32)), pa.array(size[doc].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(key)), copy, copy2, pos, pa.array(lead), ids, n_words], schema=schema
                )

    return run


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of a sorted partition, many at a time; none is empty."""
    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= _SCAN_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _arrays(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _changes(columns: list[np.ndarray], before: list | None) -> np.ndarray:
    """Where a row differs from the one before it; ``before`` is that of the first."""
    out = np.zeros(len(columns[0]), bool)
    for i, c in enumerate(columns):
        out[1:] |= c[1:] != c[:-1]
        out[0] |= before is None or c[0] != before[i]
    return out


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes compared with their neighbours.

    Of kind 0 are places that a neighbour shares the key of. Of kind 1 are the
    first and the last place of the partition, which a neighbour in another
    partition may share the key of.
    """
    names = ["key", *_COPY, "pos"]

    def rows(columns: list, kind: int) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([kind] * len(arrays[0]), pa.int32())], names=[*names, "kind"])

    last, last_shared, first = None, False, True
    for table in _tables(batches):
        cols = _arrays(table, names)
        # Rows that repeat a place are one place.
        new = _changes(cols, last)
        cols = [c[new] for c in cols]
        if not len(cols[0]):
            continue
        if first:
            yield rows([c[:1] for c in cols], 1)
            first = False
        other = _changes(cols[:1], last and last[:1])  # another key than the row before
        like = ~other
        if last is not None and like[0] and not last_shared:
            yield rows([[x] for x in last], 0)
        with_next = np.append(like[1:], False)
        yield rows([c[like | with_next] for c in cols], 0)
        last, last_shared = [c[-1] for c in cols], bool((like | with_next)[-1])
    if last is not None:
        yield rows([[x] for x in last], 1)


def _extensions(least: int):
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("first_id", pa.int64()), ("copy", pa.int64()), ("copy2", pa.int64()),
         ("start", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(4)
            for row, data, offsets in text_steps(batch.column(3)):
                starts, ends, first = words(data, offsets)
                h = word_hashes(data, starts, ends)
                n = len(first) - 1
                lists = places.slice(row, n)
                doc = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False))
                at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + first[doc]
                low = np.maximum(at - SPREAD + 1, first[doc])
                high = np.minimum(at, first[doc + 1] - least)
                ok = low <= high
                edge = np.zeros(len(h) + 2, np.int64)
                np.add.at(edge, low[ok], 1)
                np.add.at(edge, high[ok] + 1, -1)
                start = np.flatnonzero(np.cumsum(edge[: len(h)]) > 0)
                doc = np.searchsorted(first, start, side="right") - 1
                take = pa.array(doc)
                both = [run_hashes(h, start, least, _MULS[2]), run_hashes(fmix(h + np.uint64(_MULS[0])), start, least, _MULS[3])]
                ids, copy, copy2 = (batch.column(i).slice(row, n).take(take) for i in (2, 0, 1))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(as_long(x)) for x in both), ids, copy, copy2, pa.array((start - first[doc]).astype(np.int32))],
                    schema=schema,
                )

    return run


_RUN, _PLACE = ["h1", "h2"], ["no_id", "first_id", *_COPY, "start"]
_FOUND_SCHEMA = (
    "h1 long, h2 long, no_id boolean, first_id long, copy long, copy2 long, start int, "
    "source_no_id boolean, source_id long, source_copy long, source_copy2 long, source_start int, kind int"
)
_FOUND = [x.split()[0] for x in _FOUND_SCHEMA.split(", ")]


def _sources(least: int):
    """Sorted starts, each with the first place of its run as its source.

    Of kind 0 are starts that repeat their source; of kind 1 those of the
    partition's first run, whose source may lie in an earlier partition; of
    kind 2 the first place of the partition's first and last run.
    """
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    schema = pa.schema([(n, k) for n, k in zip(_FOUND, [*kinds, *kinds[2:], pa.int32()], strict=True)])

    def rows(mine: list, source: list, kind: int) -> pa.RecordBatch:
        arrays = [pa.array(np.asarray(c), t) for c, t in zip([*mine, *source], schema.types, strict=False)]
        # A place without an id has 0 there; the id itself is null.
        for flag, value in ((2, 3), (7, 8)):
            arrays[value] = pc.if_else(arrays[flag], pa.scalar(None, pa.int64()), arrays[value])
        return pa.RecordBatch.from_arrays([*arrays, pa.array([kind] * len(arrays[0]), pa.int32())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_key, source, only = None, None, True  # ``only``: all rows so far are of one run
        for table in _tables(batches):
            i = table.schema.get_field_index("first_id")
            table = table.set_column(i, "first_id", pc.fill_null(table.column("first_id"), 0))
            cols = _arrays(table, _RUN + _PLACE)
            key, place = cols[:2], cols[2:]
            began = source is None
            fresh = _changes(key, run_key)
            if began:
                source = [c[0] for c in place]
                yield rows([c[:1] for c in cols], [c[:1] for c in place], 2)
                fresh[0] = False
            # The row that each row's run begins with; -1 is the run carried over.
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), -1))
            own = begin >= 0
            sources = [np.where(own, c[begin], s) for c, s in zip(place, source, strict=True)]
            head = ~own if only else np.zeros(len(own), bool)
            if head.any():
                yield rows([c[head] for c in cols], [c[head] for c in sources], 1)
            far = (place[2] != sources[2]) | (place[3] != sources[3]) | (place[4] - sources[4] >= least)
            far &= ~head
            if far.any():
                yield rows([c[far] for c in cols], [c[far] for c in sources], 0)
            only = only and not own.any()
            run_key, source = [c[-1] for c in key], [c[-1] for c in sources]
        if source is not None:
            yield rows([[x] for x in (*run_key, *source)], [[x] for x in source], 2)

    return run


def _settled(carried: dict[tuple, tuple], least: int):
    """Starts that repeat their source, where an earlier partition may have it.

    ``carried`` has the first place of each run that crosses a border.
    """
    known = np.array([h1 for h1, _ in carried], np.int64)
    schema = pa.schema(
        [("copy", pa.int64()), ("copy2", pa.int64()), ("first_id", pa.int64()), ("start", pa.int32()), ("source_id", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, copy, copy2, start = (batch.column(n).to_numpy() for n in (*_RUN, *_COPY, "start"))
            own = [batch.column(f"source_{n}").to_numpy() for n in (*_COPY, "start")]
            source = [x.copy() for x in own]
            ids = batch.column("source_id")
            crossing = np.flatnonzero(np.isin(h1, known))
            # Few runs of a batch cross a border: they are the longest ones.
            for key in {(int(h1[i]), int(h2[i])) for i in crossing} & carried.keys():
                mine = (h1 == key[0]) & (h2 == key[1])
                _, first_id, *place = carried[key]
                for x, value in zip(source, place, strict=True):
                    x[mine] = value
                ids = pc.if_else(pa.array(mine), pa.scalar(first_id, pa.int64()), ids)
            far = (copy != source[0]) | (copy2 != source[1]) | (start - source[2] >= least)
            cols = [batch.column(n) for n in (*_COPY, "first_id", "start")]
            yield pa.RecordBatch.from_arrays([*cols, ids], schema=schema).filter(pa.array(far))

    return run


def _sorted_scan(rows: DataFrame, order: list[str], look: Callable, schema: str, name: str) -> DataFrame:
    """Range partition by the whole order, so that no key is a partition of its own; sort; scan."""
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(released(look), schema), name)


def _shared_places(suffixes: DataFrame, least: int) -> DataFrame:
    """(copy, copy2, pos) of the suffixes whose first words another place has."""
    usable = suffixes.where(F.col("pos") + (least - SPREAD + 1) <= F.col("n_words"))
    order = ["key", *_COPY, "pos"]
    found = _sorted_scan(
        usable.select(*order), order, _shared, "key long, copy long, copy2 long, pos int, kind int", "suffix-array"
    )
    # Two rows a partition at most, so a key's group is small too.
    ends = found.where("kind = 1")
    crossing = ends.groupBy("key").agg(F.count_distinct(*_COPY, "pos").alias("places")).where("places > 1").select("key")
    place = [*_COPY, "pos"]
    return found.where("kind = 0").select(*place).unionByName(ends.join(crossing, "key", "left_semi").select(*place))


def _repeated_starts(extended: DataFrame, least: int) -> DataFrame:
    """(copy, copy2, first_id, start, source_id) of the starts whose run an earlier place has."""
    rows = extended.withColumn("no_id", F.col("first_id").isNull())
    found = _sorted_scan(rows.select(*_RUN, *_PLACE), _RUN + _PLACE, _sources(least), _FOUND_SCHEMA, "start-array")
    # Two rows a partition, whatever the data: the runs that more than one
    # partition reports, at most one a border, with the earliest place of each.
    ends = found.where("kind = 2").groupBy(*_RUN).agg(F.min(F.struct(*_PLACE)).alias("f"), F.count("*").alias("n"))
    carried = {(r["h1"], r["h2"]): tuple(r["f"]) for r in ends.where("n > 1").collect()}
    return found.where("kind < 2").mapInArrow(
        released(_settled(carried, least)), "copy long, copy2 long, first_id long, start int, source_id long"
    )


def repeated_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS
) -> DataFrame:
    """Every passage of at least ``least`` words that an earlier place has.

    Returns doc_id, copy and copy2 (128 bits of the text), start_word, n_words,
    source_id. Earlier is in order of doc_id (nulls last), then text hash, then
    place; ``source_id`` is the document of the first occurrence of the
    passage's beginning. Words are runs of bytes other than ASCII white space;
    runs of words compare by 128 bits over their words' 64-bit hashes.
    Overlapping or touching repeats are one passage. Within one document, an
    occurrence that overlaps the first is no repeat. Texts with fewer words, null
    and empty ones have none. Of several documents with the same text, all but
    the first are one passage as a whole; rows that repeat id and text are one
    document. An empty table gives an empty result; other columns are not read.
    """
    if least < GRAM + SPREAD + 1:
        raise ValueError(f"at least {GRAM + SPREAD + 1} words")
    text = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *_copy_keys(F.col(text_col))
    )
    suffixes = stored(text.mapInArrow(released(_suffixes(least)), _ARRAY_SCHEMA), "suffixes")
    texts = stored(
        suffixes.where("lead").groupBy(*_COPY, "n_words", "doc_id").agg(F.count("*").alias("rows"))
        .groupBy(*_COPY, "n_words").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rows")).alias("first"),
            F.sum("rows").alias("docs"),
        ).select(*_COPY, "n_words", F.col("first.doc_id").alias("first_id"), F.col("first.rows").alias("rows"), "docs"),
        "suffix-texts",
    )
    places = _shared_places(suffixes, least).groupBy(*_COPY).agg(F.collect_set("pos").alias("places"))
    wanted = stored(places.join(texts.select(*_COPY, "first_id", "rows"), _COPY), "suffix-places")
    of_first = text["doc_id"].eqNullSafe(wanted["first_id"])
    for c in _COPY:
        of_first = of_first & (text[c] == wanted[c])
    found = text.join(wanted, of_first).select(*[wanted[c] for c in _COPY], "first_id", "text", "places", "rows")
    once = found.where("rows = 1")
    if not wanted.where("rows > 1").isEmpty():
        # Rows that repeat both id and text.
        once = once.unionByName(found.where("rows > 1").dropDuplicates(_COPY))
    extended = stored(
        once.select(*_COPY, "first_id", "text", "places").mapInArrow(
            released(_extensions(least)), "h1 long, h2 long, first_id long, copy long, copy2 long, start int"
        ),
        "extensions",
    )
    hits = stored(_repeated_starts(extended, least), "hits")
    # Runs of starts that overlap or touch are one passage; a group is one text.
    w = Window.partitionBy(*_COPY, "first_id").orderBy("start")
    fresh = F.coalesce(F.col("start") > F.lag("start").over(w) + least, F.lit(True)).cast("int")
    spans = (
        hits.withColumn("run", F.sum(fresh).over(w))
        .groupBy(*_COPY, "first_id", "run")
        .agg(
            F.min("start").alias("start_word"), (F.max("start") + least - F.min("start")).alias("n_words"),
            F.min_by("source_id", "start").alias("source_id"),
        )
        .select(F.col("first_id").alias("doc_id"), *_COPY, "start_word", "n_words", "source_id")
    )
    copies = texts.where(F.col("docs") > F.col("rows")).select(*_COPY, "n_words", "first_id")
    whole = (
        suffixes.where("lead").select("doc_id", *_COPY, "n_words").join(copies, [*_COPY, "n_words"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("doc_id", *_COPY, F.lit(0).alias("start_word"), "n_words", F.col("first_id").alias("source_id"))
    )
    return spans.unionByName(whole)


def _without(text: str | None, spans: list[dict]) -> str:
    """The text without the spans, each given by its first word and number of words."""
    raw = (text or "").encode("utf-8")
    starts, _, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    edge = np.append(starts, len(raw))
    kept, at = [], 0
    for s in sorted(spans, key=lambda s: s["start_word"]):
        kept.append(raw[at : max(at, edge[s["start_word"]])])
        at = max(at, int(edge[s["start_word"] + s["n_words"]]))
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8")


def _cutter(schema: pa.Schema, text_col: str, count_col: str | None):
    """Rows with their spans, if any: others pass as they are, a text left without words goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("__cut_spans")
            cut = spans.is_valid().to_numpy(zero_copy_only=False)
            cols = {n: batch.column(n) for n in schema.names}
            left = np.ones(len(cut), bool)
            if cut.any():
                texts, sizes = cols[text_col].to_pylist(), np.zeros(len(cut), np.int64)
                for i in np.flatnonzero(cut).tolist():
                    texts[i] = _without(texts[i], spans[i].as_py())
                    sizes[i], left[i] = len(texts[i]), texts[i].strip(" \t\n\x0b\x0c\r") != ""
                cols[text_col] = pa.array(texts, schema.field(text_col).type)
                if count_col:
                    kind = schema.field(count_col).type
                    cols[count_col] = pc.if_else(pa.array(cut), pa.array(sizes).cast(kind), cols[count_col])
            out = pa.RecordBatch.from_arrays([cols[n].cast(schema.field(n).type) for n in schema.names], schema=schema)
            yield out if left.all() else out.filter(pa.array(left))

    return run


def cut_passages(
    docs: DataFrame, passages: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars"
) -> DataFrame:
    """``docs`` without the repeated passages; all columns.

    ``passages`` is the result of ``repeated_passages`` on the same rows.
    Other text stays byte for byte. A document that has words and loses all of
    them goes. ``count_col``, where there is one, gets the new number of code
    points. Documents without such passages pass as they are.
    """
    cuts = stored(
        passages.groupBy("doc_id", *_COPY)
        .agg(F.collect_list(F.struct("start_word", "n_words")).alias("__cut_spans"))
        .withColumnsRenamed({x: f"__cut_{x}" for x in ("doc_id", *_COPY)}),
        "cuts",
    )
    same = F.col("__cut_doc_id").eqNullSafe(docs[id_col].cast("long"))
    for name, value in zip(_COPY, _copy_keys(docs[text_col]), strict=True):
        same = same & (F.col(f"__cut_{name}") == value)
    marked = docs.join(cuts, same, "left").drop(*[f"__cut_{x}" for x in ("doc_id", *_COPY)])
    counted = count_col if count_col in docs.columns else None
    return marked.mapInArrow(released(_cutter(to_arrow_schema(docs.schema), text_col, counted)), docs.schema)
