import pytest

from billing_guard.llm.common import share_package


@pytest.fixture(scope="session", autouse=True)
def _package(spark):
    share_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """A builder of documents with columns whose names clash with the operators' own."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
              "key string, tie long, rank int, `length` long, p string")

    def build(rows):
        return spark.createDataFrame([(i, t, lang, None, None, 1.0, "x", 1, 1, 1, "x") for i, t, lang in rows],
                                     schema)
    return build


def by(df, name):
    """Rows by one column, in lists."""
    out = {}
    for r in df.collect():
        out.setdefault(r[name], []).append(r)
    return out
