import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long and repeated texts, with extra columns of clashing names."""
    rows = [
        (1, "one two three four five six"), (2, None), (3, ""), (4, "!!! ..."), (4, "!!! ..."), (None, "null id here"),
        (7, "One two three, four five six"), (8, "été café 日本語 \U0001f600 naïve İΣ"), (9, "word " * 30_000),
        (9, "word " * 30_000), (10, "x"), (11, None), (-5, "mail a.b@c.example.org or +1 (415) 555-2671 now"), (12, "y" * 120_000),
    ]
    return spark.createDataFrame(
        [(i, t, "en", "s", 0, "id?", 1, "z") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, id string, n_words int, words string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
