import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    """``n`` words in sentences and lines, drawn from a vocabulary that depends on nothing but its size."""
    pick = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(vocabulary)]
    out = []
    for i in range(n):
        word = pick.choice(words)
        out.append(word + (".\n" if i % 40 == 39 else ". " if i % 9 == 8 else " "))
    return "".join(out).strip()


@pytest.fixture(scope="session")
def write_prose():
    return prose


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        full = [(i, t, "en", "a", len(t or "")) if not isinstance(t, tuple) else (i, *t) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id with two texts."""
    same = prose(5, 120)
    rows = [
        (None, prose(1, 80), "en", "a", 1),
        (1, None, None, None, None),
        (2, "", "en", "b", 0),
        (3, " \t\n\x0b\f\r \n", "fr", "b", 8),
        (4, prose(2, 40_000), "en", "a", None),
        (5, same, "en", None, 5),
        (5, same, "en", None, 5),
        (6, same, "de", "c", 5),
        (7, prose(6, 90), "en", "a", 1),
        (7, prose(7, 90), "en", "c", 1),
        (8, "x", None, "a", 1),
        (9, "ÄÖ ß 漢字漢字 \U0001f600 ²", "de", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


#: Names that operators use inside themselves, as extra columns of an input.
CLASHES = ("node", "key", "keys", "fp", "size", "own", "root", "draws", "score", "spans", "items", "bins", "rule", "line_no", "target")


@pytest.fixture(scope="session")
def clashing(odd_docs):
    return odd_docs.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHES))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rows_of():
    """The rows of a frame in an order of their own."""

    def rows(df):
        return sorted((tuple(map(str, r)) for r in df.collect()))

    return rows
