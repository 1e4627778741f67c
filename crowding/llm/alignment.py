"""Alignment of two tokenizers' tokens by whitespace-token anchors.

Both tokenizers encode the whole text. Where a token of each begins with a
space, at the same byte, both sequences are cut: the ends before it are shared.
What lies between two such anchors is a window, a tuple of ids for each
tokenizer; equal windows align equally, so a window's groups and links are
worked out once and kept under its ids. Sequences are only cut where the byte
offsets agree, which is checked, not assumed.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, stored
from .pretokens import text_groups

_GROUP_CHARS = 300_000
#: Bytes of windows that a worker keeps, twice: the elder half goes when the younger is full.
_MEMO_BYTES = 60_000_000
#: Bytes of ids above which a window is not kept.
_LONG_WINDOW = 256


def byte_level_bytes() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write.

    Printable bytes stand for themselves, the others for the characters from
    256 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevelTokens:
    """A tokenizers file of byte-level BPE; special tokens' strings are plain text.

    Where the file holds no more than that, merges in the order of their ids
    after the one pre-token pattern, its ranks go to tiktoken, which gives the
    same ids in a fifth of the time. Any other file goes to tokenizers.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        of = byte_level_bytes()
        entries = dict(file["model"]["vocab"])
        added = {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        ordinary = {k: i for k, i in entries.items() if k not in added}
        self.bytes_of = [b""] * (max([*entries.values(), *added.values()]) + 1)
        for entry, i in (entries | added).items():
            whole = entry in ordinary and all(c in of for c in entry)
            self.bytes_of[i] = bytes(of[c] for c in entry) if whole else entry.encode("utf-8")
        self.plain = self._is_plain(file, ordinary, of)
        if self.plain:
            ranks = {self.bytes_of[i]: i for i in ordinary.values()}
            from tiktoken import Encoding

            self._one = Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    @staticmethod
    def _is_plain(file: dict, ordinary: dict[str, int], of: dict[str, int]) -> bool:
        model, before = file["model"], file.get("pre_tokenizer") or {}
        other = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if file.get("normalizer") or model.get("type") != "BPE" or any(model.get(x) for x in other):
            return False
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            return False
        if not all(c in of for entry in ordinary for c in entry) or any(c not in ordinary for c in of):
            return False
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [ordinary.get("".join(m), -1) for m in merges]
        # Each merge makes a token, none is made twice, later ones have higher ids.
        return len(made) + 256 == len(ordinary) and all(x < y for x, y in zip([255, *made], made, strict=False))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the texts as they are."""
        if self.plain:
            return [np.array(self._one(t), np.uint32) for t in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        return self.encode([" " + t for t in texts])


class PieceTokens:
    """A sentencepiece file, which puts a space before the text by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i in range(self.model.get_piece_size())
            for p in [self.model.id_to_piece(i)]
        ]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


#: Marks the right side's ids in a window's key.
_RIGHT = np.uint32(1 << 31)


def align(keys: list[bytes], left: "_Side", right: "_Side") -> list[tuple[bytes, bytes]]:
    """For each window its groups as text and its links as packed 64-bit id pairs.

    A window's two id tuples have the same number of bytes, so laid end to end
    all windows keep their byte offsets on both sides. A place where either side
    has an end closes one link; where both have, it closes a group too. Each
    group's text ends with ';'.
    """
    ids = np.frombuffer(b"".join(keys), "<u4")
    size = np.cumsum([len(k) // 4 for k in keys])
    mine = ids < _RIGHT
    a, b = ids[mine].astype(np.int64), (ids[~mine] - _RIGHT).astype(np.int64)
    end_a, end_b = np.cumsum(left.length[a]), np.cumsum(right.length[b])
    # One mark a byte: 1 where a left token ends, 2 where a right one does.
    mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
    mark[end_a] = 1
    mark[end_b] += 2
    ends = np.flatnonzero(mark)
    kind = mark[ends]
    # The tokens of either side that a segment between ends lies in.
    in_a, in_b = (np.cumsum(kind & bit != 0) - (kind & bit != 0) for bit in (1, 2))
    links = a[in_a] << 32 | b[in_b]
    closes = kind == 3
    group = np.cumsum(closes) - closes
    group_a, group_b = group[kind & 1 != 0], group[kind & 2 != 0]
    # A group's left tokens, then its right ones, as rows of one table of text.
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=group[-1] + 1))]) for g in (group_a, group_b))
    place_a = np.arange(len(a)) + before_b[group_a]
    place_b = np.arange(len(b)) + before_a[group_b + 1]
    text = np.empty((len(ids), left.text.shape[1]), np.uint8)
    text[place_a], text[place_b] = left.text[a], right.text[b]
    text[place_a[closes[kind & 1 != 0]], -1] = left.after
    text[place_b[closes[kind & 2 != 0]], -1] = right.after
    shown = text != 0
    written = np.cumsum(np.count_nonzero(shown, axis=1))
    text = text[shown].tobytes()
    last = end_a[np.cumsum(mine)[size - 1] - 1]
    to_text = [0, *written[size - 1].tolist()]
    to_link = [0, *(8 * np.searchsorted(ends, last, side="right")).tolist()]
    data = links.tobytes()
    return [
        (text[i:j], data[k:m])
        for i, j, k, m in zip(to_text[:-1], to_text[1:], to_link[:-1], to_link[1:], strict=True)
    ]


class _Side:
    """What the alignment needs of a tokenizer's tokens, by id."""

    def __init__(self, bytes_of: list[bytes], after: str):
        self.length = np.array([len(x) for x in bytes_of])
        self.spaced = np.array([x[:1] == b" " for x in bytes_of])
        #: Rows of an id's digits, zeros before them, and a comma: what stands
        #: after it where others of its group follow; ``after`` where none do.
        self.after = ord(after)
        digits = "".join(f"{i:>10}," for i in range(len(bytes_of))).encode("ascii")
        self.text = np.frombuffer(digits, np.uint8).reshape(-1, 11).copy()
        self.text[self.text == ord(" ")] = 0


class Aligner:
    """Two tokenizers and the windows that this worker has aligned lately."""

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.a, self.b = _Side(left.bytes_of, "|"), _Side(right.bytes_of, ";")
        width = 1 + max(len(str(len(t.bytes_of) - 1)) for t in (left, right))
        self.a.text, self.b.text = (np.ascontiguousarray(x.text[:, -width:]) for x in (self.a, self.b))
        self.new, self.old, self.load = {}, {}, 0

    def _learn(self, keys: set[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """The windows of these keys; short ones are kept."""
        if self.load > _MEMO_BYTES:
            self.old, self.new, self.load = self.new, {}, 0
        old = self.old
        found = {k: old[k] for k in keys & old.keys()}
        fresh = list(keys - found.keys())
        if fresh:
            found.update(zip(fresh, align(fresh, self.a, self.b), strict=True))
        short = {k: v for k, v in found.items() if len(k) <= _LONG_WINDOW}
        self.new.update(short)
        self.load += 350 * len(short)
        return found

    def windows(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Cut texts' ids, laid end to end, at their anchors: keys, and each text's first.

        ``begin`` has the byte offset where each text begins, with a space, and
        the end. A key is a window's left ids, then its right ids, marked.
        """
        length_a, length_b = self.a.length[a], self.b.length[b]
        end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
        begin_a, begin_b = end_a - length_a, end_b - length_b
        mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
        mark[begin_a[self.a.spaced[a]]] = 1
        mark[begin_b[self.b.spaced[b]]] += 1
        # The ends before an anchor are shared, so both sides' windows end there.
        here = mark == 2
        cut_a, cut_b = np.flatnonzero(here[begin_a]), np.flatnonzero(here[begin_b])
        key = np.empty(len(a) + len(b), "<u4")
        window_a, window_b = np.cumsum(here[begin_a]) - 1, np.cumsum(here[begin_b]) - 1
        key[np.arange(len(a)) + cut_b[window_a]] = a
        key[np.arange(len(b)) + np.append(cut_a, len(a))[window_b + 1]] = b | _RIGHT
        data = key.tobytes()
        edge = [*(4 * (cut_a + cut_b)).tolist(), len(data)]
        return [data[i:j] for i, j in zip(edge[:-1], edge[1:], strict=True)], np.searchsorted(begin_a[cut_a], begin)

    def _spelled(self, want: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """If both sides' tokens make up these bytes, a space and a text that isn't empty."""
        of_a, of_b = self.left.bytes_of, self.right.bytes_of
        return (
            len(want) > 1
            and int(self.a.length[a].sum()) == len(want) == int(self.b.length[b].sum())
            and b"".join([of_b[i] for i in b.tolist()]) == want
            # A plain file's merges spell every byte of what they are given.
            and (self.left.plain or b"".join([of_a[i] for i in a.tolist()]) == want)
        )

    def texts(self, texts: list[str]) -> list[tuple]:
        """Of each text: n_a, n_b, n_groups, n_links, groups' digest, pairs and their counts as arrays."""
        # Nothing here makes cycles; the collector would only go through all kept windows again and again.
        on = gc.isenabled()
        gc.disable()
        try:
            return self._texts(texts)
        finally:
            if on:
                gc.enable()

    def _texts(self, texts: list[str]) -> list[tuple]:
        none = np.zeros(0, np.int64)
        out: list[tuple] = [(0, 0, 0, 0, "", none, none)] * len(texts)
        wanted = [b" " + t.encode("utf-8") for t in texts]
        ids = zip(wanted, self.left.ids(texts), self.right.ids(texts), strict=True)
        used = [(i, a, b) for i, (want, a, b) in enumerate(ids) if self._spelled(want, a, b)]
        if not used:
            return out
        a, b = (np.concatenate([x[side] for x in used]) for side in (1, 2))
        keys, first = self.windows(a, b, np.cumsum([0, *(len(wanted[i]) for i, _, _ in used)]))
        found = list(map(self.new.get, keys))
        if None in found:
            lost = {k for k, v in zip(keys, found, strict=True) if v is None}
            learned = self._learn(lost)
            found = [learned[k] if v is None else v for k, v in zip(keys, found, strict=True)]
        first = first.tolist()
        for (i, x, y), lo, hi in zip(used, first[:-1], first[1:], strict=True):
            groups, links = zip(*found[lo:hi], strict=True)
            text = b"".join(groups)
            packed = np.frombuffer(b"".join(links), np.int64)
            pairs, count = np.unique(packed, return_counts=True)
            digest = hashlib.sha256(text[:-1]).hexdigest()
            out[i] = (len(x), len(y), text.count(b";"), len(packed), digest, pairs, count)
        return out


_aligners: dict[tuple, Aligner] = {}


def aligner(left: Callable, left_path: str, right: Callable, right_path: str) -> Aligner:
    """This worker's copy of both tokenizers."""
    key = (left, left_path, right, right_path)
    if key not in _aligners:
        _aligners[key] = Aligner(left(left_path), right(right_path))
    return _aligners[key]


_NAMES = ["n_a", "n_b", "n_groups", "n_links"]


def linked_documents(
    docs: DataFrame, left_path: str, right_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and pair_counts of every text.

    ``left_path`` is a byte-level BPE file, which encodes space + text;
    ``right_path`` a sentencepiece file. ``pairs`` has the distinct linked id
    pairs (left << 32 | right), ``pair_counts`` how many links each has.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), *((n, pa.int64()) for n in _NAMES), ("groups_sha256", pa.string()),
         ("pairs", pa.list_(pa.int64())), ("pair_counts", pa.list_(pa.int32()))]
    )

    def lists(parts: list[np.ndarray], kind) -> pa.Array:
        edge = np.cumsum([0, *map(len, parts)])
        flat = np.concatenate([np.zeros(0, np.int64), *parts])
        return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(flat, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(ByteLevelTokens, left_path, PieceTokens, right_path)
        for batch in batches:
            for first, texts in text_groups(batch.column(1).to_pylist(), _GROUP_CHARS):
                cols = list(zip(*own.texts(texts), strict=True))
                ids = batch.column(0).slice(first, len(texts))
                made = [pa.array(c, f.type) for c, f in zip(cols[:5], list(schema)[1:6], strict=True)]
                arrays = [ids, *made, lists(cols[5], pa.int64()), lists(cols[6], pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        released(run),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, pair_counts array<int>",
    )


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, n_links of the corpus, and if it is the most for its right id (ties included)."""
    each = linked.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("x"))
    counts = stored(
        each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_counts").alias("count")), "pair-counts"
    )
    right = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = counts.groupBy(right.alias("right")).agg(F.max("count").alias("most"))
    return counts.join(top, right == F.col("right")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(
    docs: DataFrame, left_path: str, right_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Groups lie between byte offsets where tokens of both sides end; a link is
    a pair of tokens whose bytes overlap. ``n_best`` are the links whose id pair
    has the most links, corpus-wide, of its right id; ``count_sum`` adds the
    corpus-wide counts of all links' pairs. Texts that are null, empty, or that
    one side's tokens don't spell byte for byte have no tokens: zeros and ''.
    Ids may be null or repeat; a row is a document. An empty table gives an
    empty result; other columns are not read.
    """
    linked = stored(
        linked_documents(docs, left_path, right_path, id_col=id_col, text_col=text_col)
        .withColumn("row", F.monotonically_increasing_id()),
        "linked",
    )
    scores = stored(pair_counts(linked), "pair-scores")
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "pair_counts")).alias("x"))
    each = each.select("row", F.col("x.pairs").alias("pair"), F.col("x.pair_counts").cast("long").alias("times"))
    sums = each.join(scores, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return linked.drop("pairs", "pair_counts").join(sums, "row", "left").select(
        "doc_id", *_NAMES, zero("n_best"), zero("count_sum"), "groups_sha256"
    )
