import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and river stone cloud harbour winter lantern copper meadow signal".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 31 + i * i + i * seed) % len(WORDS)] + str((seed * 7 + i) % 5) for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, and
    columns that clash with what operators add."""
    rows = [
        (0, sentence(0, 80), "en", "a", 1), (1, None, "en", None, None), (2, "", None, "a", 0), (3, " \n\t ", "de", "b", 4),
        (4, sentence(4, 80), "en", "a", 1), (4, sentence(4, 80), "en", "a", 1), (None, sentence(5, 60), None, None, None),
        (6, "x" * 150_000, "fr", "a", 150_000), (7, "\n".join([sentence(7, 12)] * 3), "en", "a", 2), (8, sentence(0, 80), "en", "a", 1),
        (9, "один два три четыре 一二三 é ü", "ru", "c", 5), (10, "a", "en", "a", 1), (7, sentence(11, 30), "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.selectExpr("*", "'clash' as score", "1 as n_words", "2 as place", "3 as fp", "4 as _version", "5 as _score", "6 as _found", "7 as pos")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def vocabulary_path():
    from synthcurate.llm.queries import vocabulary

    return vocabulary
