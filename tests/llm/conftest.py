import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text) rows, with an extra column that clashes with internal names."""

    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t), 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, node int")

    return make
