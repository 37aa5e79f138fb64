import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, _text string, _doc string, keep int, score string, word string, start int, kept int"


@pytest.fixture(scope="session")
def frame(spark):
    """Build documents with extra columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), 7, "x", "y", 1, "z", "w", 3, 4) for i, t, s in rows], SCHEMA
        )

    return make


LONG = "lorem ipsum dolor sit amet " * 40_000


@pytest.fixture(scope="session")
def odd(frame):
    """NULLs, empty and blank texts, repeated rows and ids, one very long text."""
    return frame(
        [
            (1, None, "a"),
            (2, "", "a"),
            (3, " \t\n ", None),
            (4, "one", None),
            (5, "the same row of words again and again and again", "b"),
            (5, "the same row of words again and again and again", "b"),
            (5, "another text under the same id", "b"),
            (None, "a text without an id", "c"),
            (None, None, None),
            (9, LONG, "c"),
            (10, "é" * 40 + "\n\n\n" + "ß", "c"),
            (11, "w" * 3000, "c"),
        ]
    )


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
