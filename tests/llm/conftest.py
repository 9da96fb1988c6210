import pytest

from recordforge.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", **{"spark.sql.shuffle.partitions": "8"})


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text[, lang, source])."""

    def make(rows, columns="doc_id bigint, text string, lang string, source string, n_chars bigint"):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, columns)

    return make
