"""Near duplicates, repeated passages and phrase fingerprints against brute force."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from crowding.llm import components, fingerprint, minhash, queries, suffixes

from .conftest import PASSAGE


def shingles(text, k=5):
    w = re.findall(r"[^ \t\n\x0b\f\r]+", text or "")
    return frozenset(tuple(w[i : i + k]) for i in range(max(min(1, len(w)), len(w) - k + 1)))


def brute_classes(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or both >= threshold * (len(sets[a]) + len(sets[b]) - both) and both:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return {min((x for x in g if x is not None), default=None): sorted(map(str, g)) for g in groups.values()}


def variants(n, seed):
    """Texts of 120 words that differ from each other in a few words."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        w = list(out[rng.integers(len(out))] if out and rng.random() < 0.5 else base)
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(120)] = f"x{rng.integers(1000)}"
        out.append(w)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("small, rare", [(16, 8), (2, 3)])
def test_classes_equal_brute_force(spark, monkeypatch, small, rare):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(minhash, "RARE", rare)
    rows = list(enumerate(variants(90, 1) + [f"other text number {i} with its own words" for i in range(20)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in minhash.near_duplicates(df).collect():
        got[r["class_id"]].append(str(r["doc_id"]))
    assert {k: sorted(v) for k, v in got.items()} == brute_classes(rows)


def repeating_pages():
    """Pages in four copies: each with its own footer, or the page's own line,
    repeated once to hundreds of times."""
    rows = []
    for page in range(15):
        body = " ".join(f"p{page}w{i}" for i in range(120))
        line = " ".join(f"p{page}l{i}" for i in range(8))
        for copy, times in enumerate((50, 300, 1, 300)):
            footer = " ".join(f"p{page}c{copy}f{i}" for i in range(6))
            rows.append(f"{body} " + " ".join([line if copy > 1 else footer] * times))
    return list(enumerate(rows))


def test_classes_of_texts_that_repeat_lines(spark):
    rows = repeating_pages()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in minhash.near_duplicates(df).collect():
        got[r["class_id"]].append(str(r["doc_id"]))
    want = brute_classes(rows)
    assert len(want) == 15
    assert {k: sorted(v) for k, v in got.items()} == want


def test_near_duplicates_edge_rows(edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    classes = minhash.near_duplicates(edge)
    got = defaultdict(list)
    for r in classes.collect():
        got[r["class_id"]].append(str(r["doc_id"]))
    # Texts without words are one class, with doc 1 and a row without id.
    assert {k: sorted(v) for k, v in got.items()} == brute_classes(rows)
    kept = minhash.one_of_each(edge, classes)
    assert kept.columns == edge.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, brute_classes(rows)))
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.one_of_each(nothing, minhash.near_duplicates(nothing)).count() == 0


def test_registers_estimate_probability_jaccard():
    """Share of equal registers against the weighted similarity itself."""
    a = {i: 1.0 + i % 3 for i in range(60)}
    b = {i: 1.0 + (i + i // 50) % 3 for i in range(20, 80)}
    exact = sum(
        1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys()
    )
    m = 4000
    rows = [
        minhash.prob_min_hash(np.zeros(len(s), np.int64), np.array(list(s), np.uint64), np.array(list(s.values())), 1, m)
        for s in (a, b)
    ]
    assert abs((rows[0] == rows[1]).mean() - exact) < 4 * (exact * (1 - exact) / m) ** 0.5


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), (6, None), (10, 9), (9, 8), (3, 1)]
    links += [(100 + i, 101 + i) for i in range(40)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df, "a", "b").collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8} | {100 + i: 100 for i in range(41)}
    assert got == want
    assert components.components(df.limit(0), "a", "b").count() == 0


def brute_repeats(rows, least=50):
    """Word positions of each text that an earlier place has, and first occurrences."""
    texts = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        texts.setdefault((i, t), re.findall(r"[^ \t\n\x0b\f\r]+", t or ""))
    order = sorted(texts, key=lambda k: (k[0] is None, k[0] or 0, hashlib.md5((k[1] or "").encode()).digest()))
    first, again = {}, defaultdict(set)
    for key in order:
        w = texts[key]
        for s in range(len(w) - least + 1):
            run = tuple(w[s : s + least])
            place = first.setdefault(run, (key, s))
            if place[0] != key or s - place[1] >= least:
                again[key[0]].update(range(s, s + least))
    return {k: v for k, v in again.items() if v}


def check_repeats(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    passages = suffixes.repeated_passages(df)
    got = defaultdict(set)
    for r in passages.collect():
        got[r["doc_id"]].update(range(r["start_word"], r["start_word"] + r["n_words"]))
    assert got == brute_repeats(rows)
    return passages


@pytest.fixture
def many_partitions(spark):
    """Sorted arrays of small inputs keep all their partitions, and so their borders."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_a_run_over_many_sorted_partitions(spark, many_partitions):
    """One passage in most of the texts, others in two: their runs cross borders."""
    rng = np.random.default_rng(8)
    shared = [f"s{i}" for i in range(64)]
    rows = []
    for i in range(160):
        w = [f"t{i}x{j}" for j in range(int(rng.integers(0, 40)))]
        w += shared[int(rng.integers(0, 8)) :] if i % 4 else [f"pair{i // 8}w{j}" for j in range(55)]
        w += [f"u{i}x{j}" for j in range(int(rng.integers(0, 40)))]
        rows.append((i if i != 77 else None, " ".join(w)))
    rows += rows[40:44] + [(1000, rows[1][1]), (1001, " ".join(shared * 3))]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def sorted_parts(df, order):
    """Rows that lie in several partitions in this order."""
    return df.repartitionByRange(4, *order).sortWithinPartitions(*order)


def test_neighbours_across_borders(spark, many_partitions):
    """Whatever rows a partition ends with: every key that two places have is found."""
    rng = np.random.default_rng(3)
    rows = [(int(k), int(c), 7, int(p)) for k, c, p in zip(rng.choice([1, 1, 1, *range(2, 60)], 400), rng.integers(0, 40, 400), rng.integers(0, 3, 400), strict=True)]
    rows += rows[:30]
    df = spark.createDataFrame([(*r, 1000) for r in rows], "key long, copy long, copy2 long, pos int, n_words int")
    got = suffixes._shared_places(df, 50).distinct().collect()
    places = defaultdict(set)
    for k, *place in set(rows):
        places[k].add(tuple(place))
    assert {tuple(r) for r in got} == {p for v in places.values() if len(v) > 1 for p in v}


def test_hash_equal_starts_that_differ_are_no_match(spark, many_partitions):
    """Sources are told by both hashes; runs come from their first place, over borders."""
    rng = np.random.default_rng(5)
    rows = [(1, int(h), None if d == 9 else int(d), int(d), 0, int(s)) for h, d, s in zip(rng.choice([0, 0, 0, *range(30)], 500), rng.integers(0, 10, 500), rng.integers(0, 120, 500), strict=True)]
    rows = list(set(rows))
    df = spark.createDataFrame(rows, "h1 long, h2 long, first_id long, copy long, copy2 long, start int")
    first, want = {}, set()
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, *r[3:])):
        f = first.setdefault(r[:2], r)
        if f[3:5] != r[3:5] or r[5] - f[5] >= 50:
            want.add((r[3], r[4], r[2], r[5], f[2]))
    got = suffixes._repeated_starts(df, 50).collect()
    assert {tuple(r) for r in got} == want and len(got) == sum(
        1 for r in rows if (f := first[r[:2]])[3:5] != r[3:5] or r[5] - f[5] >= 50
    )


def test_repeats_equal_brute_force(spark, small_docs):
    rng = np.random.default_rng(4)
    word = [f"v{i}" for i in range(400)]
    common = [[word[j] for j in rng.integers(400, size=rng.integers(45, 80))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = [word[j] for j in rng.integers(400, size=rng.integers(0, 120))]
        for c in rng.integers(6, size=rng.integers(0, 4)):
            at = rng.integers(len(w) + 1)
            cut = rng.integers(0, 8)
            w[at:at] = common[c][cut : len(common[c]) - rng.integers(0, 8)]
        rows.append((i, " ".join(w)))
    rows += [(100, "a " * 130), (101, "b c " * 70), rows[3], (102, rows[5][1]), (103, rows[5][1])]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    check_repeats(small_docs)


def test_repeats_edge_rows(edge, nothing):
    passages = check_repeats(edge)
    found = {r["doc_id"]: r for r in passages.collect()}
    assert found[10]["source_id"] == 9 and found[10]["n_words"] >= 60 and 9 not in found
    cut = suffixes.cut_passages(edge, passages)
    assert cut.columns == edge.columns
    out = {r["doc_id"]: r for r in cut.collect()}
    assert out[10]["text"] == "Something else begins here, then and goes on." == out[10]["text"].replace(PASSAGE, "")
    assert out[10]["n_chars"] == len(out[10]["text"]) and out[9]["text"].count(PASSAGE) == 1
    assert cut.count() == edge.count()
    assert suffixes.repeated_passages(nothing).count() == 0
    assert suffixes.cut_passages(nothing, suffixes.repeated_passages(nothing)).count() == 0


def test_a_text_that_is_all_repeats_goes(spark):
    df = spark.createDataFrame([(1, "x " + PASSAGE), (2, PASSAGE), (3, "y")], "doc_id long, text string")
    kept = suffixes.cut_passages(df, suffixes.repeated_passages(df))
    assert sorted(map(tuple, kept.collect())) == [(1, "x " + PASSAGE), (3, "y")]


def phrases(data):
    seen, p = set(), b""
    for b in data:
        p += bytes([b])
        if p not in seen:
            seen.add(p)
            p = b""
    return seen


def test_phrases_are_lz78():
    for t in ("", "a", "aaaaaaaaaa", "abababab", "être ou ne pas être, telle est la question"):
        tree = fingerprint.lz_phrases(t.encode())
        words = [b""]
        for key in tree:
            words.append(words[key >> 8] + bytes([key & 255]))
        assert set(words[1:]) == phrases(t.encode()) and len(words) == len(tree) + 1


def test_likeness_estimates_phrase_jaccard(small_docs):
    texts = [r["text"] for r in small_docs.orderBy("doc_id").limit(40).collect()]
    s = fingerprint.signatures(texts)
    real = [len(phrases(a.encode()) & phrases(b.encode())) / len(phrases(a.encode()) | phrases(b.encode())) for a, b in zip(texts, texts[1:], strict=False)]
    assert np.abs(fingerprint.likeness(s[:-1], s[1:]) - real).mean() < 0.06
    assert (fingerprint.likeness(s, s) == 1).all()
    assert fingerprint.likeness(fingerprint.signatures([""]), fingerprint.signatures([""]))[0] == 1


def test_fingerprint_edge_rows(spark, edge, nothing, monkeypatch):
    monkeypatch.setattr(fingerprint, "DOCS_A_RANGE", 4)
    rows = [(r["doc_id"], r["text"] or "") for r in edge.collect()]
    out = fingerprint.compare_in_order(edge).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in rows)
    made = {t: f for (_, t), f in zip(rows, fingerprint.as_text(fingerprint.signatures([t for _, t in rows])), strict=True)}
    # Ids 2 to 6 and 8 to 11 are unique, so their next document is certain.
    text = dict(rows)
    for r in out:
        if r["doc_id"] in (2, 3, 4, 5, 8, 9, 10):
            t, follow = text[r["doc_id"]], text[r["doc_id"] + 1]
            half = len(t) // 2
            assert r["edited"] == t[: len(t) - half] + follow[:half]
            assert r["fingerprint"] == made[t] and r["n_chars"] == len(t)
    plain = {(str(r["doc_id"]), r["fingerprint"]) for r in fingerprint.fingerprints(edge).collect()}
    assert plain == {(str(r["doc_id"]), r["fingerprint"]) for r in out}
    assert fingerprint.compare_in_order(nothing).count() == 0
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert fingerprint.compare_in_order(one).first()["edited"] == "abcabc"


def test_fingerprint_query_order(spark, small_docs, monkeypatch):
    monkeypatch.setattr(fingerprint, "DOCS_A_RANGE", 13)
    out = {r["doc_id"]: r for r in queries.QUERIES["op4_fingerprint"](spark, "/root/testdata/sf0.001").collect()}
    rows = [(r["doc_id"], r["text"]) for r in small_docs.orderBy("doc_id").collect()]
    assert len(out) == len(rows)
    for (i, t), (_, follow) in zip(rows, [*rows[1:], rows[0]], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        s = fingerprint.signatures([t, edited, follow])
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i]["near_edited"] == pytest.approx(fingerprint.likeness(s[:1], s[1:2])[0])
        assert out[i]["near_next"] == pytest.approx(fingerprint.likeness(s[:1], s[2:])[0])
