from __future__ import annotations

import random
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"

SYLLABLES = "ta re mi so lu ne ka vo pi da er on".split()


def invented(words: int, seed: int) -> list[str]:
    """Words of one to three syllables, always the same for a seed."""
    source = random.Random(seed)
    return ["".join(source.choices(SYLLABLES, k=source.randint(1, 3))) for _ in range(words)]


def schema_with_clashes(extra: str = "") -> str:
    """Documents' columns, and others called what operators call theirs."""
    clashes = "key string, row int, n_tokens string, class int, line string, `list` int, kept string, id string"
    return f"doc_id long, text string, lang string, {clashes}{extra}"


def document(spark_rows: list, doc_id, text, lang=None) -> None:
    spark_rows.append((doc_id, text, lang, "k", 1, "n", 2, "l", 3, "x", "i"))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and ties, beside columns with clashing names."""
    rows: list = []
    long = " ".join(invented(30_000, 1))
    texts = [None, "", " \t\n ", "one", "a b c d", "a b c d", long, long + " end", "A b C d\n\nA b C d", "12 34 !?"]
    texts += ["naïve café 中文 текст 😀", "x" * 5000, "\n".join(["same line again and again here"] * 3)]
    for number, text in enumerate(texts):
        document(rows, number, text, "en" if number % 2 else None)
    document(rows, 4, "a b c d", "en")
    document(rows, None, "a row without a key", None)
    document(rows, None, None, None)
    return spark.createDataFrame(rows, schema_with_clashes())


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], schema_with_clashes())


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(SF_DIR).is_dir():
        pytest.skip("test tables are not here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents) -> dict[int, str]:
    return {row.doc_id: row.text or "" for row in documents.select("doc_id", "text").collect()}
