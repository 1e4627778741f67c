"""The pipeline's stages: their order, what they return, and a brute-force rerun."""

import re

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from crowding.llm.common import stored

from .test_duplicates import brute_classes, brute_repeats

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, small_docs):
    accepted, known, one_each, cut, packed = run_stages(spark, small_docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "language", "near_duplicates", "repeated_passages", "packing"
    ]
    for x in (accepted, known, one_each, cut):
        assert x.columns == small_docs.columns
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    assert sorted(r["doc_id"] for r in one_each.collect()) == sorted(brute_classes(rows))
    rows = [(r["doc_id"], r["text"]) for r in one_each.collect()]
    gone = brute_repeats(rows)
    want = {}
    for i, t in rows:
        words = re.findall(r"[^ \t\n\x0b\f\r]+", t)
        left = [w for j, w in enumerate(words) if j not in gone.get(i, ())]
        if left:
            want[i] = left
    got = {r["doc_id"]: r for r in cut.collect()}
    assert {i: r["text"].split() for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for i, r in got.items() if i in gone)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in packed.orderBy("doc_id", "start").collect():
        pieces.setdefault(r["doc_id"], []).extend(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    for i, r in got.items():
        assert pieces[i] == [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
    assert set(pieces) == set(got)


def test_stages_keep_clean_documents(spark, small_docs):
    accepted, known, *_ = run_stages(spark, small_docs)[:2]
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    n = small_docs.join(clean, "doc_id").count()
    assert accepted.join(clean, "doc_id").count() >= 0.98 * n
    assert known.join(clean, "doc_id").count() >= 0.97 * n


def test_language_stage_on_unlearned_languages(spark, small_docs):
    """A model of few texts splits them evenly; README says what a larger one does."""
    texts = {
        -1: "Η γλώσσα αυτού του κειμένου δεν είναι γνωστή στο μοντέλο και όμως παίρνει μία ετικέτα",
        -2: "これは 学習 されて いない 言語 の 文章 です",
        -3: "W tym tekście nie ma ani jednego zdania w języku, który model poznał podczas nauki",
        -4: "12 34 !!",
        -5: "",
    }
    rows = [(i, t, None, "s", len(t)) for i, t in texts.items()]
    docs = small_docs.unionByName(spark.createDataFrame(rows, small_docs.schema))
    kept = corpus_pipeline.language_stage(spark, docs, SF).where("doc_id < 0").collect()
    assert kept == []


def test_edge_and_empty_tables(spark, edge, nothing):
    for docs in (edge, nothing):
        out = run_stages(spark, docs)
        assert all(x.columns == docs.columns for x in out[:-1])
        assert out[-1].columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert out[-1].count() == 0


def test_run_is_registered(spark):
    import __spark_entry__

    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        re.sub(r"^(op\d+_).*", r"\1", x) for x in __spark_entry__.queries()
    }
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None
