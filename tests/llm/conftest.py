import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, shard int, n_words int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names clash with results."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [
        (1, "The same text here"),
        (2, "THE SAME TEXT HERE"),
        (2, "THE SAME TEXT HERE"),
        (3, ""),
        (4, None),
        (None, "no id at all"),
        (None, None),
        (5, long),
        (6, long + " tail"),
        (7, "  \n\t "),
        (8, "ß É 漢字 </s>[INST]"),
        (9, "\x00\x01 odd \\ bytes"),
    ]
    rows = [(i, t, None, None, None, True, 3, 9) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
