import pytest

#: Columns that the operators use inside, on the input as extra columns.
CLASH = ["class", "key", "block", "part", "rank", "n", "score", "size", "row", "possible", "kept", "id",
         "bloom_block", "lane_0", "edits", "chars", "tokens", "spans", "t", "found", "listed", "canon"]


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table of (doc_id, text) rows with clashing columns."""
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASH)
        full = [(i, t, None, None, None if t is None else len(t), *["x"] * len(CLASH)) for i, t in rows]
        return spark.createDataFrame(full, schema)
    return make


#: NULL id, NULL, empty and blank texts, repeated rows, odd characters, a long text.
ODD = [(None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text twice here now"),
       (5, "same text twice here now"), (6, "\U0001F600 é ́ ǅ \x1c <|endoftext|> ß"), (7, "word " * 30_000),
       (8, "x" * 60_000)]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)
