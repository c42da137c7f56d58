"""Documents that operators must take in any case, and views of brute force over them."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, component long"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.5, "x", 7)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows and ids, clashing names."""
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [
        row(1, passage), row(2, f"lead {passage} tail"), row(2, f"lead {passage} tail"), row(3, None, None, None), row(4, ""), row(5, " \t\n\u00a0"),
        row(None, "null id text here", None, "b"), row(6, "same same same same " * 40), row(7, "é à ü \u0001 token=abc123xyz\n" * 3), row(8, "one", None, None),
        row(9, " ".join(f"long{i % 977}" for i in range(30_000)), "de", "b"), row(10, passage.upper(), "en", None), row(11, "***", "fr", "a"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
