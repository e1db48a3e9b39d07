import pytest

#: Rows that every operator on documents must take: null, empty, blank, repeated, very long, null id.
ODD = [
    (1, "one two three four five six\nAll rights reserved here.", "en"),
    (1, "one two three four five six\nAll rights reserved here.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n ", "en"),
    (None, "a text without an id, of seven words", "en"),
    (5, "word " * 30_000, "en"),
    (6, "x" * 100_000, "en"),
    (7, "mail a.b@example.net or +1 (743) 555-3824\ntoken = \"0123456789abcdef0123456789abcdef\"", "en"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns named like columns the operators make or use."""
    rows = [(i, t, lang, "a", 1, 2, 3, b"s") for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, id string, n_lines int, n_entities int, _hash int, sig binary")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
