import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)

LONG = "lorem ipsum dolor sit amet consectetur " * 3000
PASSAGE = " ".join(f"shared{i}" for i in range(60))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, copy string, score string, id string, part string"


def edge_rows():
    texts = {
        1: None,
        2: "",
        3: " \n\t ",
        4: "12 34 !!",
        5: "naïve Ünïcode 日本語 text with odd  spaces \r\n\r\n end",
        6: LONG,
        7: "one two three four five six seven eight nine ten eleven twelve",
        8: "one two three four five six seven eight nine ten eleven twelve",
        9: f"alpha beta gamma. {PASSAGE} delta epsilon.",
        10: f"Something else begins here, then {PASSAGE} and goes on.",
        11: "\0nul \0 bytes",
    }
    rows = [(i, t, "en" if i % 2 else None, "s", len(t) if t else None) for i, t in texts.items()]
    rows += [rows[6], rows[6], (None, "no id at all", None, None, None), (None, None, None, None, None)]
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
