"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. Their votes
overlap; expectation-maximisation over the counts of all vote patterns
estimates how each labeller votes on good and on bad documents, and so the
posterior of every pattern. The posteriors of a bounded sample train a linear
scorer over hashed features, which then scores every document.

The driver holds the pattern counts (at most 3 ** 9), the sample's features
and the weights, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fmix, released, text_steps, word_hashes, words

#: Documents that the scorer learns from.
TRAIN_DOCS = 4000
FEATURES = 2048
#: Score from which a document is accepted.
ACCEPT = 0.4

#: Bytes of text at which the scorer's evidence counts half.
SHRINK_BYTES = 60

#: Labellers: name, good up to, bad from. Shares of words or bytes.
LABELLERS = [
    ("symbols_a_word", 0.05, 0.25),
    ("upper_share", 0.2, 0.5),
    ("exclamations_a_word", 0.05, 0.25),
    ("pipes_a_word", 0.02, 0.2),
    ("stutter_share", 0.1, 0.3),
    ("second_stutter_share", 0.1, 0.3),
    ("repeated_pair_share", 0.3, 0.5),
    ("repeated_line_share", 0.3, 0.6),
    ("other_byte_share", 0.15, 0.3),
]
#: Share of good documents on which a labeller may vote bad, at most.
MOST_FALSE_ALARMS = 0.01
_POWERS = 3 ** np.arange(len(LABELLERS))

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _share(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each document's bytes the mask holds for."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


def measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labellers' measure of each document, and its number of words."""
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    w = np.maximum(n_words, 1)
    h = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(n_words)), n_words)

    def counted(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[len(doc) - len(mask) :], weights=mask, minlength=len(n_words))

    stutter = counted((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))
    second = counted((h[2:] == h[:-2]) & (doc[2:] == doc[:-2]))
    pair = (doc[1:].astype(np.uint64) << np.uint64(44)) | fmix(h[1:] + fmix(h[:-1])) >> np.uint64(20)
    pair = np.sort(pair[doc[1:] == doc[:-1]])
    repeated = (pair[1:][pair[1:] == pair[:-1]] >> np.uint64(44)).astype(np.int64)
    pairs = np.bincount(repeated, minlength=len(n_words))
    solid = _share(~_SPACE[data], offsets)
    letters = _share(_LETTER[data], offsets)
    # Lines by the sum of their words' hashes, weighted by place.
    line = np.concatenate([[0], np.cumsum(data == 10)])[starts] if len(starts) else np.zeros(0, np.int64)
    again = np.zeros(len(n_words))
    if len(h):
        head = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])]))
        size = np.diff(np.append(head, len(h)))
        place = (np.arange(len(h)) - np.repeat(head, size)).astype(np.uint64)
        key = np.add.reduceat(fmix(h + place), head)
        owner = doc[head]
        order = np.lexsort((np.arange(len(head)), key, owner))
        repeat = np.zeros(len(head), bool)
        repeat[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        again = np.bincount(owner, weights=size * repeat, minlength=len(n_words))
    out = np.stack(
        [
            _share(_SYMBOL[data], offsets) / w,
            _share(_UPPER[data], offsets) / np.maximum(_share(_ASCII_LETTER[data], offsets), 1),
            _share(data == ord("!"), offsets) / w,
            _share(data == ord("|"), offsets) / w,
            stutter / w,
            second / w,
            pairs / w,
            again / w,
            1 - letters / np.maximum(solid, 1),
        ],
        axis=1,
    )
    return out, n_words


def patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Vote pattern of each document: base-3 digits, 0 nothing, 1 good, 2 bad.

    No labeller votes on a document without words.
    """
    m, n_words = measures(data, offsets)
    vote = np.zeros(m.shape, np.int64)
    for j, (_, good, bad) in enumerate(LABELLERS):
        vote[:, j] = np.where(m[:, j] <= good, 1, np.where(m[:, j] >= bad, 2, 0))
    vote[n_words == 0] = 0
    return vote @ _POWERS


def digits(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // _POWERS % 3


def fit_votes(pattern: np.ndarray, count: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """EM: log P(vote | class) as [labeller, class, vote] (class 1 is good) and
    the share of good documents. Starts from the majority of votes."""
    vote = digits(pattern)
    good, bad = (vote == 1).sum(axis=1), (vote == 2).sum(axis=1)
    # One bad vote weighs as much as all the others' silence.
    p = np.where(bad > 0, 0.05 + 0.1 * (good > 3 * bad), 0.95)
    one_hot = (vote[:, :, None] == np.arange(3)).astype(float)
    for _ in range(rounds):
        table = np.stack(
            [np.einsum("n,njv->jv", count * q, one_hot) + 0.5 for q in (1 - p, p)], axis=1
        )
        table /= table.sum(axis=2, keepdims=True)
        # Labellers err rarely on good documents: that tells the classes apart.
        over = np.maximum(table[:, 1, 2] - MOST_FALSE_ALARMS, 0)
        table[:, 1, 2] -= over
        table[:, 1, 0] += over
        log_vote = np.log(table)
        share = (np.sum(count * p) + 0.5) / (count.sum() + 1)
        new = posterior(pattern, log_vote, share)
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    return log_vote, float(share)


def posterior(pattern: np.ndarray, log_vote: np.ndarray, share: float) -> np.ndarray:
    """P(good | votes)."""
    vote = digits(pattern)
    both = log_vote[np.arange(vote.shape[1])[None, :], :, vote].sum(axis=1)
    odds = both[:, 1] - both[:, 0] + np.log(share / (1 - share))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


_TRI = [fmix(np.arange(256, dtype=np.uint64) + np.uint64(s << 8)) for s in (1, 2, 3)]


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed feature of the trigram that begins at each byte, within its document."""
    n = len(data)
    end = offsets[1:][np.diff(offsets) > 0] - 1
    second, third = np.zeros(n + 1, np.uint64), np.zeros(n + 2, np.uint64)
    second[: n - 1] = _TRI[1][data[1:]]
    third[: n - 2] = _TRI[2][data[2:]]
    second[end] = 0
    third[end] = 0
    third[end[end > 0] - 1] = 0
    h = _TRI[0][data] + second[:n] + third[:n]
    return (h >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)


def _sum(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum between neighbouring edges, the same wherever the values stand."""
    out = np.zeros(len(edges) - 1)
    some = np.diff(edges) > 0
    if some.any():
        out[some] = np.add.reduceat(values, edges[:-1][some])
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of FEATURES shares: hashed byte trigrams, then word events."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    bucket = _trigrams(data, offsets)
    out = np.bincount(doc * FEATURES + bucket, minlength=n * FEATURES).reshape(n, FEATURES) / np.maximum(size, 1)[:, None]
    event, first = _events(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    more = np.bincount(owner * FEATURES + event, minlength=n * FEATURES).reshape(n, FEATURES)
    return (out + more / np.maximum(np.diff(first), 1)[:, None]).astype(np.float32)


def _events(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hashed event a word: its length class, and whether it repeats the
    word before; with the first word's index per document."""
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[first[:-1][np.diff(first) > 0]] = False
    kind = np.minimum(ends - starts, 31) * 2 + same
    return (fmix(kind.astype(np.uint64) + np.uint64(1 << 32)) >> np.uint64(40)).astype(np.int64) & (FEATURES - 1), first


def fit_scorer(x: np.ndarray, p: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels: gradient
    descent with momentum on standardised features and a small ridge. Both
    classes weigh the same."""
    if len(x) == 0:
        return np.zeros(FEATURES), 0.0
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-4
    z = ((x - mean) / std).astype(np.float32)
    weight = p / max(p.sum(), 1) + (1 - p) / max((1 - p).sum(), 1)
    weight = (weight / weight.sum()).astype(np.float32)
    w, b, vw, vb = np.zeros(FEATURES, np.float32), 0.0, 0.0, 0.0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30)))
        g = weight * (q - p)
        vw = 0.9 * vw - 0.05 * (z.T @ g + 1e-3 * w)
        vb = 0.9 * vb - 0.05 * float(g.sum())
        w, b = w + vw, b + vb
    w = w.astype(np.float64) / std
    return w, float(b - mean @ w)


@dataclass(frozen=True)
class QualityModel:
    """What ``fit`` learns: vote tables, share of good documents, weights."""

    log_vote: np.ndarray
    share: float
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(good) of each document by the scorer; 0 without words."""
        bucket = _trigrams(data, offsets)
        size = np.diff(offsets)
        event, first = _events(data, offsets)
        count = np.diff(first)
        z = _sum(self.weights[bucket], offsets) / np.maximum(size, 1) + self.bias
        z += _sum(self.weights[event], first) / np.maximum(count, 1)
        # A short text is little evidence: its score stays near the share of good ones.
        prior = np.log(self.share / (1 - self.share))
        z = prior + (z - prior) * size / (size + SHRINK_BYTES)
        return np.where(count > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0)


def fit(docs: DataFrame, *, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> QualityModel:
    """Learn from all documents' votes, and the scorer from the ``train_docs``
    distinct texts with the smallest hashes; copies count once. Their features
    are computed where the texts lie, and of each text FEATURES floats come to
    the driver: 33 MB in all by default. No labels are read. Without documents, every score is 0.5 or, without words, 0."""
    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_steps(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(patterns(data, offsets))], names=["pattern"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(0)):
                rows = [r.tobytes() for r in features(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, len(rows)), pa.array(patterns(data, offsets)), pa.array(rows, pa.binary())],
                    names=["hash", "pattern", "features"],
                )

    counted = text.mapInArrow(released(vote), "pattern long").groupBy("pattern").count().orderBy("pattern").collect()
    log_vote, share = fit_votes(
        np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted], float)
    )
    # Over one and a half times the sample by the hash, then the smallest.
    filled = text.where(F.col("text") != "").withColumn("hash", F.xxhash64("text"))
    n = filled.agg(F.count_distinct("hash")).first()[0]
    place = F.pmod("hash", F.lit(1 << 30))
    cut = int((1 << 30) * min(1.0, (1.5 * train_docs + 50) / max(n, 1)))
    near = filled.where(place < cut)
    chosen = near.select("hash").distinct().orderBy(place, "hash").limit(train_docs)
    # The chosen hashes are at most train_docs numbers.
    looked = near.join(F.broadcast(chosen), "hash").select("text", "hash")
    seen = (
        looked.mapInArrow(released(look), "hash long, pattern long, features binary")
        .groupBy("hash").agg(F.min("pattern").alias("pattern"), F.min("features").alias("features"))
        .orderBy(place, "hash").collect()
    )
    x = np.stack([np.frombuffer(r["features"], np.float32) for r in seen]) if seen else np.zeros((0, FEATURES), np.float32)
    p = posterior(np.array([r["pattern"] for r in seen], np.int64), log_vote, share)
    weights, bias = fit_scorer(x, p)
    return QualityModel(log_vote, share, weights, bias)


def classify(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, weak (posterior of the votes), score and accepted of every whole text.

    ``accepted`` is score >= ACCEPT. Null, empty and blank texts have score 0.
    Ids may be null or repeat; equal texts have equal scores; an empty table
    gives an empty result; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("weak", pa.float64()), ("score", pa.float64()), ("accepted", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(1)):
                score = model.scores(data, offsets)
                weak = posterior(patterns(data, offsets), model.log_vote, model.share)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(score)), pa.array(weak), pa.array(score), pa.array(score >= ACCEPT)],
                    schema=schema,
                )

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        released(run), "doc_id long, weak double, score double, accepted boolean"
    )


def keep_accepted(docs: DataFrame, model: QualityModel, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is accepted, all columns as they are."""
    at = docs.columns.index(text_col)
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(at)):
                part = batch.slice(first, len(offsets) - 1)
                kept = part.filter(pa.array(model.scores(data, offsets) >= ACCEPT))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(t) for c, t in zip(kept.columns, schema.types, strict=True)], schema=schema
                )

    return docs.mapInArrow(released(run), docs.schema)
