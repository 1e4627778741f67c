"""Quality classifier and language ID: held-out accuracy, exact inference, edge rows."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowding.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_quality_against_labels(spark):
    """The labels table is never read in training; it only judges."""
    out = queries.QUERIES["op2_quality"](spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    right = np.mean([r["accepted"] == (r["quality"] == 1) for r in rows])
    clean = [r["accepted"] for r in rows if r["quality"] == 1]
    assert right > 0.97 and np.mean(clean) > 0.985
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_em_finds_labeller_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.85
    vote = np.ones((len(good), len(quality.LABELLERS)), int)
    hit = rng.random(vote.shape) < 0.7
    vote[~good] = np.where(hit[~good], 2, 1)
    vote[good] = np.where(rng.random((good.sum(), vote.shape[1])) < 0.002, 2, vote[good])
    pattern, count = np.unique(vote @ quality._POWERS, return_counts=True)
    log_vote, share = quality.fit_votes(pattern, count.astype(float))
    assert share == pytest.approx(0.85, abs=0.01)
    assert np.exp(log_vote)[:, 0, 2] == pytest.approx(0.7, abs=0.05)
    p = quality.posterior(vote @ quality._POWERS, log_vote, share)
    assert ((p > 0.5) == good).mean() > 0.99


def test_quality_edge_rows(edge, nothing):
    model = quality.fit(edge)
    out = quality.classify(edge, model).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 and 0 <= r["weak"] <= 1 for r in out)
    assert all(r["score"] == 0 and not r["accepted"] for r in out if r["doc_id"] in (1, 2, 3))
    assert len({r["score"] for r in out if r["doc_id"] == 7}) == 1
    kept = quality.keep_accepted(edge, model)
    assert kept.columns == edge.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out if r["accepted"])
    empty = quality.fit(nothing)
    assert quality.classify(nothing, empty).count() == quality.keep_accepted(nothing, empty).count() == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 8])
    scores, moves = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    p, expected, log_z = langid.marginals(scores, moves, first)
    want_p, want_e, want_z = np.zeros_like(scores), np.zeros((3, 3)), 0.0
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if lo == hi:
            continue
        total, part, move = 0.0, np.zeros((hi - lo, 3)), np.zeros((3, 3))
        for y in product(range(3), repeat=hi - lo):
            v = np.exp(
                sum(scores[lo + i, y[i]] for i in range(hi - lo)) + sum(moves[a, b] for a, b in zip(y, y[1:], strict=False))
            )
            total += v
            for i in range(hi - lo):
                part[i, y[i]] += v
            for a, b in zip(y, y[1:], strict=False):
                move[a, b] += v
        want_p[lo:hi], want_e, want_z = part / total, want_e + move / total, want_z + np.log(total)
    assert np.allclose(p, want_p) and np.allclose(expected, want_e) and np.isclose(log_z, want_z)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.QUERIES["op5_langid"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert 0.2 * len(rows) < len(held) < 0.3 * len(rows) and np.mean(held) > 0.97


def test_code_switched_text(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["n_chars"] > 500]
    en, de = ([r["text"] for r in docs if r["lang"] == x][:80] for x in ("en", "de"))
    model = langid.fit_texts(en + de, ["en"] * len(en) + ["de"] * len(de))

    def pure(texts, column):
        for t in texts:
            share, _ = model.shares(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
            if share[0, column] > 0.98:
                return [w for w in t.split() if w[0].isalpha()]

    mixed = " ".join(pure(en, 1)[:60] + pure(de, 0)[:20])
    raw = mixed.encode()
    share, n = model.shares(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert model.langs == ["de", "en"] and share[0, 1] == pytest.approx(0.75, abs=0.1)


def test_interleaved_languages_are_told_apart(spark):
    """Spans of a few words in turn: most words get their own language."""
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["n_chars"] > 500]
    en, de = ([r["text"] for r in docs if r["lang"] == x][:80] for x in ("en", "de"))
    model = langid.fit_texts(en[:60] + de[:60], ["en"] * len(en[:60]) + ["de"] * len(de[:60]))
    both = [[w for t in texts[60:] for w in t.split() if w.isalpha()] for texts in (de, en)]
    mixed, want, at = [], [], [0, 0]
    for turn in range(40):
        lang, size = turn % 2, 5 + turn % 7
        mixed += both[lang][at[lang] : at[lang] + size]
        want += [lang] * size
        at[lang] += size
    raw = " ".join(mixed).encode()
    data = np.frombuffer(raw, np.uint8)
    words = langid.read_words(data, np.array([0, len(raw)]))
    assert len(words.hashes) == len(want)
    p, _, _ = langid.marginals(model.emissions(words), model.moves, words.first)
    assert np.mean(p.argmax(axis=1) == np.array(want)) > 0.85
    share, _ = model.shares(data, np.array([0, len(raw)]))
    assert share[0, 1] == pytest.approx(np.mean(want), abs=0.15)


def copied_texts(spark):
    """40 texts: the ones with the smallest and the largest place have 3000 copies each."""
    texts = [f"text number {i} of the {i * i} that have words of their own" for i in range(40)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    order = [r["text"] for r in df.orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 30))).collect()]
    rows = texts + 3000 * [order[0], order[-1]]
    return order, spark.createDataFrame([(t, "en") for t in rows], df.schema).repartition(3)


def test_language_sample_has_distinct_texts(spark, monkeypatch):
    order, docs = copied_texts(spark)
    seen = []
    monkeypatch.setattr(langid, "fit_texts", lambda texts, labels: seen.append((texts, labels)))
    langid.fit(docs, train_texts=10)
    langid.fit(docs, train_texts=100)
    # Whole texts as long as their bytes fit; the first one comes even if it doesn't.
    langid.fit(docs, train_texts=10, train_bytes=sum(len(t) for t in order[:4]) + 1)
    langid.fit(docs, train_bytes=3)
    assert seen == [
        (order[:10], ["en"] * 10), (order, ["en"] * 40), (order[:4], ["en"] * 4), (order[:1], ["en"])
    ]


def test_language_sample_reads_whole_texts_of_the_largest_languages(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit_texts", lambda texts, labels: seen.append((texts, labels)))
    long = "a very long text " * 9000
    rows = [(f"text {i} in {x}", x) for x, n in (("fr", 3), ("en", 2), ("de", 2), ("xx", 1)) for i in range(n)]
    docs = spark.createDataFrame([*rows, (long, "fr"), (None, "yy"), ("no language", None)], "text string, lang string")
    langid.fit(docs, train_langs=2)
    ((texts, labels),) = seen
    assert sorted(set(labels)) == ["de", "fr"] and long in texts and len(texts) == 6


def test_quality_sample_has_distinct_texts(spark, monkeypatch):
    order, docs = copied_texts(spark)
    seen = []
    monkeypatch.setattr(quality, "fit_scorer", lambda x, p: seen.append(x) or (np.zeros(quality.FEATURES), 0.0))
    quality.fit(docs, train_docs=10)
    quality.fit(docs, train_docs=100)
    for x, texts in zip(seen, (order[:10], order), strict=True):
        raw = [t.encode() for t in texts]
        want = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert sorted(map(bytes, x)) == sorted(map(bytes, want.astype(np.float32)))


def test_languages_edge_rows(edge, nothing):
    model = langid.fit(edge)
    out = langid.predict(edge, model).collect()
    assert model.langs == ["en"] and len(out) == edge.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in out if r["doc_id"] in (1, 2, 3, 4))
    assert all(r["lang_pred"] == "en" for r in out if r["doc_id"] in (5, 6, 7))
    kept = langid.keep_known(edge, model, 0.4)
    assert kept.columns == edge.columns and {1, 2, 3, 4}.isdisjoint(r["doc_id"] for r in kept.collect())
    unread = langid.fit(nothing)
    assert unread.langs == [] and langid.predict(nothing, unread).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge, unread).collect()} == {"und"}


ODD = [
    "", " \n ", "a", "!!! ### | |", "one one two two two one two one two", "same line here\nsame line here\nother line\nsame line here\n",
    "UPPER lower MiXed 123", "na\u00efve \u65e5\u672c\u8a9e", "x" * 300, "a b a b a b a b", "tab\tand\x0bfeed\x0c", "line\n\nline\nline",
]


def slow_measures(text):
    """The labellers' measures, word by word."""
    raw, words = text.encode(), text.encode().split()
    n = max(len(words), 1)
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    stutter = sum(x == y for x, y in zip(words, words[1:], strict=False))
    second = sum(x == y for x, y in zip(words, words[2:], strict=False))
    pairs = list(zip(words, words[1:], strict=False))
    lines = [tuple(x.split()) for x in raw.split(b"\n") if x.split()]
    solid = sum(b not in b" \t\n\r\x0b\x0c" for b in raw)
    upper = sum(65 <= b <= 90 for b in raw)
    ascii_letters = sum(letter(b) and b < 128 for b in raw)
    return [
        sum(b in b"#$%&*+/<=>@[\\]^_`{|}~" for b in raw) / n, upper / max(ascii_letters, 1), raw.count(b"!") / n,
        raw.count(b"|") / n, stutter / n, second / n, (len(pairs) - len(set(pairs))) / n,
        sum(len(x) for i, x in enumerate(lines) if x in lines[:i]) / n, 1 - sum(map(letter, raw)) / max(solid, 1),
    ]


def slow_score(model, text):
    """Weights of the text's trigrams and word events, one at a time."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return 0.0
    z = 0.0
    for i in range(len(raw)):
        h = sum(int(quality._TRI[k][raw[i + k]]) for k in range(3) if i + k < len(raw))
        z += model.weights[(h % 2**64 >> 40) & (quality.FEATURES - 1)] / len(raw)
    z += model.bias
    for i, w in enumerate(words):
        kind = min(len(w), 31) * 2 + (i > 0 and w == words[i - 1])
        h = int(quality.fmix(np.array([kind + (1 << 32)], np.uint64))[0])
        z += model.weights[(h >> 40) & (quality.FEATURES - 1)] / len(words)
    prior = np.log(model.share / (1 - model.share))
    z = prior + (z - prior) * len(raw) / (len(raw) + quality.SHRINK_BYTES)
    return 1 / (1 + np.exp(-min(max(z, -50), 50)))


def test_quality_equals_brute_force(spark, small_docs):
    texts = ODD + [r["text"] or "" for r in small_docs.limit(60).collect()]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    got, n_words = quality.measures(data, offsets)
    assert n_words.tolist() == [len(t.split()) for t in raw]
    assert np.allclose(got, [slow_measures(t) for t in texts])
    votes = quality.digits(quality.patterns(data, offsets))
    for t, v in zip(texts, votes.tolist(), strict=True):
        want = [1 if m <= good else 2 if m >= bad else 0 for m, (_, good, bad) in zip(slow_measures(t), quality.LABELLERS, strict=True)]
        assert v == (want if t.split() else [0] * len(want))
    model = quality.fit(small_docs)
    rows = [(i, t) for i, t in enumerate(texts)]
    out = quality.classify(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), model)
    by_id = {r["doc_id"]: r for r in out.collect()}
    for i, t in rows:
        want = slow_score(model, t)
        assert by_id[i]["score"] == pytest.approx(want, abs=1e-9) and by_id[i]["accepted"] == (by_id[i]["score"] >= quality.ACCEPT)
