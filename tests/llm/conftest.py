import pytest

# Names the operators use inside, as extra columns of their inputs.
CLASHING = "row string, key string, first long, n long, block string, place string, _row string, source_doc long, fingerprint long, id long, rep long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]) with extra, clashing columns."""

    def make(rows):
        full = [(d, t, "en", s[0] if s else "s", None if t is None else len(t), *["x", "y", 1, 2, "z", "p", "q", 3, 4, 5, 6]) for d, t, *s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING).repartition(3)

    return make


@pytest.fixture(scope="session")
def rows():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
