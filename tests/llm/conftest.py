import pytest

LONG = " ".join(f"word{k % 977} tail{k}" for k in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 30, "en", "s0", 5, "x", 1, 2),
        (1, "The quick brown fox jumps over the lazy dog. " * 30, "en", "s0", 5, "x", 1, 2),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "s0", 0, "", 0, 0),
        (4, " \t\n ", "en", None, 4, "x", 1, 1),
        (None, "a text without an id but with a mail someone@example.org in it", None, "s1", 9, "x", 1, 1),
        (5, LONG, "de", "s1", len(LONG), "x", 1, 1),
        (6, "é" * 70_000, "de", "s1", 70_000, "x", 1, 1),
        (7, "7" * 50_000, "de", "s1", 50_000, "x", 1, 1),
        (8, "one", "fr", "s1", 3, "x", 1, 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _text string, id long, node long"
    return spark.createDataFrame(rows, schema).withColumnsRenamed({"node": "score"})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
