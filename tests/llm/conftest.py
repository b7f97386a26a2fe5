import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from texts (doc_id by place) or from (doc_id, text, lang, source) rows, with extra columns of clashing names."""

    def rows(texts, extra=()):
        got = [t if isinstance(t, tuple) else (i, t, "en", "s") for i, t in enumerate(texts)]
        got = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(extra)) for r in got]
        return spark.createDataFrame(got, SCHEMA + "".join(f", {c} string" for c in extra))

    return rows
