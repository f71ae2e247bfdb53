import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, fp string, component_id string, key int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"word{i % 977} the" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat today", "en", "a"), (1, "the cat sat on the mat today", "en", "a"), (2, None, None, None), (None, "nobody's text at all", "en", "b"),
        (None, None, None, None), (3, "", "fr", "b"), (4, " \t\n\x0b\x0c\r", "de", ""), (5, long, "en", "a"), (6, long + " tail", "en", "a"),
        (7, "é ß 你好 \x00 <|endoftext|> I'll", "es", "c"), (8, "The Cat sat on the mat today", "en", "c"), (9, "12 34 !!", None, "c"),
    ]
    return spark.createDataFrame([(*r, 9, 1, -1.0, "x", "y", 0) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
