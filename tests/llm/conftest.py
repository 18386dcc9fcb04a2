import pytest


@pytest.fixture
def documents(spark):
    """Builder of a documents table with columns that also name intermediate results."""
    def build(rows):
        full = [(i, text, lang, source, None, "x", 1) for i, text, lang, source in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "component string, size int")
    return build


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


ODD = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "b"), (None, "a lone text without an id", "en", "a"),
       (4, "word", "en", "a"), (5, "word", "en", "a"), (5, "word", "en", "a"), (6, "éß " * 30_000, "de", "b"),
       (7, "12 34 !!", "en", None)]
