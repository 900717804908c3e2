import pytest

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Makes a documents table with the edge cases every operator must take:
    NULL ids and texts, empty and blank texts, repeated rows, and extra columns
    with names that the operators use inside."""

    def make(texts=(), edges=True):
        rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]
        if edges:
            rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, " \n\t ", "en", "s", 4), (None, "a row without an id", "en", "s", 19), (1003, "said twice", "en", "s", 10), (1003, "said twice", "en", "s", 10)]
        df = spark.createDataFrame(rows, DOC_COLUMNS)
        for clash in ("row_key", "id_key", "score", "k", "kind", "fp", "carry", "parts", "block", "hits", "z"):
            df = df.selectExpr("*", f"'x' AS {clash}")
        return df

    return make


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOC_COLUMNS)
