"""Language of each word, and so of each text, by a linear-chain CRF.

A text's words form a chain whose labels are languages. A word's score for a
language adds learned weights of its hashed features: affixes of 1 to 3 bytes,
byte trigrams with the word's borders, and whether a lexicon of words seen in
one language mostly holds it. Learned transitions tie neighbours. Forward and
backward sums give each word's marginals, so a code-switched text has a share
of each language; the text's language is the largest share.

Words are runs of ASCII letters and of bytes above 127, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fmix, released, text_steps, word_hashes

#: The sample that the model learns from: distinct whole texts of each language,
#: their bytes together, and the languages. 13 million bytes hold 200 texts of
#: 65,536 bytes.
TRAIN_TEXTS = 200
TRAIN_BYTES = 13 << 20
TRAIN_LANGS = 256
#: Parts of at most so many words that a training step sees as chains.
CHAIN_WORDS = 64
CHAINS_A_STEP = 64
EPOCHS = 2
#: Parts to one chain of two languages in turn.
SWITCHED_EVERY = 6
#: A lexicon word occurs so often in the training texts, mostly in one language.
LEXICON_COUNT, LEXICON_SHARE = 4, 0.9

_BUCKETS = 1 << 15
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_TRI = [fmix(np.arange(258, dtype=np.uint64) + np.uint64(s << 9)) for s in (1, 2, 3)]
_AFFIX = [[fmix(np.arange(256, dtype=np.uint64) + np.uint64((9 + 3 * a + i) << 9)) for i in range(3)] for a in (0, 1)]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (fmix(h) >> np.uint64(49)).astype(np.int32)


@dataclass
class Words:
    """Words of some texts and their hashed features."""

    first: np.ndarray  # index of each text's first word, and the end
    starts: np.ndarray  # where each word's bytes begin in ``tri``
    tri: np.ndarray  # trigram bucket of each letter byte
    affix: np.ndarray  # six buckets a word; _BUCKETS for none
    hashes: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = _LOWER[data]
    # The two-byte capitals of Latin-1.
    follows = np.zeros(len(low), bool)
    follows[1:] = low[:-1] == 0xC3
    capital = follows & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)
    low[capital] += 32
    letter = _LETTER[low]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    cut = offsets[:-1][offsets[:-1] < len(low)]
    begin[cut] = letter[cut]
    starts = np.flatnonzero(begin)
    first = np.searchsorted(starts, offsets)
    end = letter.copy()
    end[:-1] &= ~letter[1:] | begin[1:]
    ends = np.flatnonzero(end) + 1
    if len(starts) == 0:
        none = np.zeros(0, np.int64)
        return Words(first, none, none, np.zeros((0, 6), np.int64), np.zeros(0, np.uint64))
    left = np.zeros(len(low), np.int16)
    left[1:] = low[:-1]
    left[starts] = 256
    right = np.zeros(len(low), np.int16)
    right[:-1] = low[1:]
    right[ends - 1] = 257
    h = _TRI[0][left[letter]]
    h += _TRI[1][low[letter]]
    h += _TRI[2][right[letter]]
    tri = _bucket(h)
    size = ends - starts
    affix = np.full((len(starts), 6), _BUCKETS, np.int32)
    for a in (0, 1):
        h = np.zeros(len(starts), np.uint64)
        for i in range(3):
            has = size > i
            at = np.where(has, starts + i if a == 0 else ends - 1 - i, starts)
            h = h + _AFFIX[a][i][low[at]]
            affix[:, 3 * a + i] = np.where(has, _bucket(h), _BUCKETS)
    return Words(first, np.cumsum(size) - size, tri, affix, word_hashes(low, starts, ends))


@dataclass
class LanguageModel:
    """Learned weights; ``langs`` in ascending order."""

    langs: list[str]
    weights: np.ndarray = field(repr=False)  # (buckets + 1) x languages; the last row is zero
    lexicon: np.ndarray = field(repr=False)  # ascending word hashes
    lexicon_lang: np.ndarray = field(repr=False)
    lexicon_weights: np.ndarray = field(repr=False)  # (languages + 1) x languages
    moves: np.ndarray = field(repr=False)  # languages x languages

    def entries(self, w: Words) -> np.ndarray:
        """Which language's lexicon holds each word; the number of languages for none."""
        k = len(self.langs)
        if len(self.lexicon) == 0:
            return np.full(len(w.hashes), k)
        at = np.minimum(np.searchsorted(self.lexicon, w.hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == w.hashes, self.lexicon_lang[at], k)

    def emissions(self, w: Words) -> np.ndarray:
        if len(w.starts) == 0:
            return np.zeros((0, len(self.langs)))
        out = np.add.reduceat(self.weights[w.tri], w.starts, axis=0)
        for j in range(6):
            out += self.weights[w.affix[:, j]]
        return out + self.lexicon_weights[self.entries(w)]

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's mean marginals, and its number of words."""
        w = read_words(data, offsets)
        n = np.diff(w.first)
        p, _, _ = marginals(self.emissions(w), self.moves, w.first)
        doc = np.repeat(np.arange(len(n)), n)
        total = np.stack([np.bincount(doc, weights=p[:, j], minlength=len(n)) for j in range(len(self.langs))], axis=1)
        return total / np.maximum(n, 1)[:, None], n


def marginals(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many chains at once.

    Returns each word's label probabilities, the expected number of moves
    between labels, and the sum of the chains' log partition functions.
    """
    k = moves.shape[0]
    size = np.diff(first)
    expected = np.zeros((k, k))
    if len(scores) == 0:
        return np.zeros((0, k)), expected, 0.0
    scores = scores.astype(np.float64)
    # Chains in descending length; words place by place, so that a place's
    # words of all chains lie together.
    rank = np.argsort(-size, kind="stable")
    rank = rank[size[rank] > 0]
    longest = int(size[rank[0]])
    alive = np.searchsorted(-size[rank], -np.arange(longest), side="left")
    edge = np.concatenate([[0], np.cumsum(alive)])
    chain = np.arange(len(scores)) - np.repeat(edge[:-1], alive)
    order = first[rank[chain]] + np.repeat(np.arange(longest), alive)
    e = scores[order]
    top = e.max(axis=1, keepdims=True)
    e = np.exp(e - top)
    shift = moves.max()
    a = np.exp(moves - shift)
    log_z = float(top.sum()) + shift * float(len(scores) - len(rank))
    forward, scale = np.empty_like(e), np.empty(len(e))
    for t in range(longest):
        lo, hi = edge[t], edge[t + 1]
        now = e[lo:hi] if t == 0 else e[lo:hi] * (forward[edge[t - 1] : edge[t - 1] + hi - lo] @ a)
        scale[lo:hi] = s = now.sum(axis=1)
        forward[lo:hi] = now / s[:, None]
    log_z += float(np.log(scale).sum())
    p = np.empty_like(e)
    back = np.ones((0, k))
    for t in range(longest - 1, -1, -1):
        lo, hi = edge[t], edge[t + 1]
        here = np.ones((hi - lo, k))
        n = len(back)
        if n:
            nlo = edge[t + 1]
            ahead = e[nlo : nlo + n] * back / scale[nlo : nlo + n, None]
            here[:n] = ahead @ a.T
            expected += a * (forward[lo : lo + n].T @ ahead)
        p[lo:hi] = forward[lo:hi] * here
        back = here
    out = np.empty_like(p)
    out[order] = p
    return out, expected, log_z


def _part(w: Words, lo: int, hi: int) -> Words:
    """The words from ``lo`` to ``hi`` as chains of CHAIN_WORDS."""
    begin = w.starts[lo]
    end = w.starts[hi] if hi < len(w.starts) else len(w.tri)
    cuts = np.append(np.arange(0, hi - lo, CHAIN_WORDS), hi - lo)
    return Words(cuts, w.starts[lo:hi] - begin, w.tri[begin:end], w.affix[lo:hi], w.hashes[lo:hi])


def _switched(parts: list, label: np.ndarray, rng: np.random.Generator) -> list:
    """Chains that change between two languages every few words, made of the parts' words.

    One for every SWITCHED_EVERY parts; without them no transition between
    languages would ever be seen.
    """
    out = []
    for _ in range(len(parts) // SWITCHED_EVERY):
        both = [parts[i][0] for i in rng.integers(len(parts), size=2)]
        if label[both[0][0]] == label[both[1][0]]:
            continue
        chain, at = [], [lo for lo, _ in both]
        for turn in range(CHAIN_WORDS):
            i = turn % 2
            end = min(at[i] + int(rng.integers(3, 13)), both[i][1])
            if end == at[i]:
                break
            chain.append((at[i], end))
            at[i] = end
        out.append(chain)
    return out


def fit_texts(texts: list[str], labels: list[str]) -> LanguageModel:
    """Learn from texts and their languages: every word of a text has its label.

    Maximises the chains' conditional likelihood by Adagrad steps over parts of
    one text after another's, in a fixed shuffled order.
    """
    langs = sorted(set(labels))
    k = len(langs)
    number = {x: i for i, x in enumerate(langs)}
    weights = np.zeros((_BUCKETS + 1, k))
    moves = np.zeros((k, k))
    lex_weights = np.zeros((k + 1, k))
    raw = [t.encode("utf-8") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    w = read_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    label = np.repeat([number[x] for x in labels], np.diff(w.first)) if labels else np.zeros(0, np.int64)
    found, index = np.unique(w.hashes, return_inverse=True)
    count = np.bincount(index * k + label, minlength=len(found) * k).reshape(len(found), k) if k else np.zeros((0, 0))
    total = count.sum(axis=1) if k else np.zeros(0)
    sure = (total >= LEXICON_COUNT) & (count.max(axis=1, initial=0) >= LEXICON_SHARE * total) if k else np.zeros(0, bool)
    model = LanguageModel(
        langs, weights, found[sure], count[sure].argmax(axis=1) if sure.any() else np.zeros(0, np.int64), lex_weights, moves
    )
    if len(w.hashes) == 0:
        return model
    # Parts are shuffled, so that a step has chains of all languages.
    rng = np.random.default_rng(1)
    parts = []
    for lo, hi in zip(w.first[:-1], w.first[1:], strict=True):
        parts += [[(x, min(x + CHAIN_WORDS, hi))] for x in range(lo, hi, CHAIN_WORDS)]
    parts += _switched(parts, label, rng)
    grown = [np.full(x.shape, 1e-6) for x in (weights, lex_weights, moves)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(parts))
        for at in range(0, len(order), CHAINS_A_STEP):
            some = [parts[i] for i in order[at : at + CHAINS_A_STEP]]
            spans = [x for part in some for x in part]
            pieces = [_part(w, lo, hi) for lo, hi in spans]
            many = np.array([sum(hi - lo for lo, hi in part) for part in some])
            shift = np.cumsum([len(x.tri) for x in pieces]) - [len(x.tri) for x in pieces]
            step = Words(
                np.concatenate([[0], np.cumsum(many)]),
                np.concatenate([x.starts + s for x, s in zip(pieces, shift, strict=True)]),
                np.concatenate([x.tri for x in pieces]),
                np.concatenate([x.affix for x in pieces]),
                np.concatenate([x.hashes for x in pieces]),
            )
            y = label[np.concatenate([np.arange(lo, hi) for lo, hi in spans])]
            p, expected, _ = marginals(model.emissions(step), moves, step.first)
            p[np.arange(len(y)), y] -= 1
            seen = np.zeros((k, k))
            inner = np.ones(len(y), bool)
            inner[step.first[:-1]] = False
            np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
            per_byte = np.repeat(np.arange(len(y)), np.diff(np.append(step.starts, len(step.tri))))
            bucket = np.concatenate([step.tri, step.affix.ravel()])
            owner = np.concatenate([per_byte, np.repeat(np.arange(len(y)), 6)])
            entry = model.entries(step)
            grads = [
                np.stack([np.bincount(bucket, weights=p[owner, j], minlength=_BUCKETS + 1) for j in range(k)], axis=1),
                np.stack([np.bincount(entry, weights=p[:, j], minlength=k + 1) for j in range(k)], axis=1),
                expected - seen,
            ]
            grads[0][_BUCKETS] = 0
            for x, g, a in zip((weights, lex_weights, moves), grads, grown, strict=True):
                g = g / len(some)
                a += g * g
                x -= 0.2 * g / np.sqrt(a)
    model.weights, model.lexicon_weights = weights.astype(np.float32), lex_weights.astype(np.float32)
    return model


def fit(
    labelled: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    train_texts: int = TRAIN_TEXTS,
    train_bytes: int = TRAIN_BYTES,
    train_langs: int = TRAIN_LANGS,
) -> LanguageModel:
    """Learn from a bounded sample of distinct whole texts; copies count once.

    Of each language, its texts in the order of their hashes, as long as there
    are at most ``train_texts`` of at most ``train_bytes`` together; a text that
    doesn't fit ends the sample unless it is the first. So train_bytes a
    language come to the driver, or one text. The model knows the ``train_langs``
    languages with the most distinct texts (of equally many, those that sort
    first). Rows with a null text or language teach nothing; without any others
    the model knows no language."""
    base = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    distinct = base.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("n"))
    counts = {r["lang"]: r["n"] for r in distinct.orderBy(F.desc("n"), "lang").limit(train_langs).collect()}
    if not counts:
        return fit_texts([], [])
    # Over twice the sample of each language by the hash, then the first ones.
    cut = {x: int((1 << 30) * min(1.0, (2 * train_texts + 50) / n)) for x, n in counts.items()}
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(v) for pair in sorted(cut.items()) for v in pair])
    w = Window.partitionBy("lang").orderBy("place", "hash")
    # The order is of hashes and sizes; texts come by them, for the chosen alone.
    near = base.withColumn("place", place).where(F.col("place") < F.element_at(limit, F.col("lang")))
    sizes = near.groupBy("lang", "place", F.xxhash64("text").alias("hash")).agg(F.max(F.octet_length("text")).alias("size"))
    chosen = (
        sizes.withColumn("r", F.row_number().over(w))
        .withColumn("bytes", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where((F.col("r") == 1) | ((F.col("r") <= train_texts) & (F.col("bytes") <= train_bytes)))
        .select("lang", "hash", "r")
    )
    # At most train_langs * train_texts rows of three short columns.
    sample = (
        near.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "hash"])
        .groupBy("lang", "hash", "r").agg(F.min("text").alias("text"))
        .orderBy("lang", "r").select("text", "lang").collect()
    )
    return fit_texts([r["text"] for r in sample], [r["lang"] for r in sample])


def _predict(model: LanguageModel, column: pa.Array) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(first row, languages, scores) of a text column."""
    for first, data, offsets in text_steps(column):
        n = len(offsets) - 1
        langs, score = [UNKNOWN] * n, np.zeros(n)
        if model.langs:
            share, count = model.shares(data, offsets)
            best = share.argmax(axis=1)
            plain = np.concatenate([[0], np.cumsum(_LETTER[_LOWER[data]] & (data < 128))])
            plain = plain[offsets[1:]] > plain[offsets[:-1]]
            for i in np.flatnonzero(count > 0):
                # Bytes above 127 alone may be no letters.
                if plain[i] or any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8"))):
                    langs[i], score[i] = model.langs[best[i]], min(1.0, share[i, best[i]])
        yield first, langs, score


def predict(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (the language's share) of every whole text.

    ``und`` and 0 for null texts, texts without a letter, and a model that
    knows no language; ties go to the language that sorts first. Ids may be
    null or repeat; equal texts have equal results; an empty table gives an
    empty result; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, langs, score in _predict(model, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(langs)), pa.array(langs, pa.string()), pa.array(score)], schema=schema
                )

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        released(run), "doc_id long, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: LanguageModel, least: float, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language whose share is at least ``least``,
    all columns as they are."""
    at = docs.columns.index(text_col)
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, langs, score in _predict(model, batch.column(at)):
                keep = np.array([x != UNKNOWN for x in langs], bool) & (score >= least)
                kept = batch.slice(first, len(langs)).filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(t) for c, t in zip(kept.columns, schema.types, strict=True)], schema=schema
                )

    return docs.mapInArrow(released(run), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text
    leaves 2 when divided by 4; a null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
