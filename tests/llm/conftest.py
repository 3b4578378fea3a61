import pytest

from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key long"


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a very long text and
    a very long word, and extra columns with names the operators use inside."""
    words = " ".join(f"w{i * 7919 % 30_011}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (5, "One  TWO"),
            (None, "no id here at all but some words"), (None, None), (6, words), (7, "x" * 50_000),
            (8, "a b c d e f. " * 30), (9, "a b c d e f. " * 30), (10, "É Σ 龍 <|endoftext|> ok"),
            (10, "other text of the same id")]
    return spark.createDataFrame([(i, t, None, "s", len(t) if t else None, "r", 0) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
