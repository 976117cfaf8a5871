import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, repeated rows, one word, special strings, wide characters, a long text."""
    prose = " ".join(f"word{i % 97} and {i}" for i in range(400))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, prose), (6, prose), (7, prose + " more"), (8, prose[:-1]),
        (9, "<|endoftext|> a<|endoftext|>"), (10, "ß漢字🙂" * 30), (11, "ß漢字🙂" * 40), (12, "a" * 200_000), (13, "..., ---"), (None, prose), (14, "\x85\u00a0x\u3000y"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with columns that clash with those that operators make."""
    return spark.createDataFrame(
        [(k, t, "en" if k and k % 2 else None, "s", 1, "x", 2.5, [1]) for k, t in odd_rows],
        "doc_id long, text string, lang string, source string, n_chars long, found string, score double, doc array<int>",
    )
