import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from marketlens.llm.common import prepare
    prepare(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, body string, kept boolean, row string, text_key long"


def docs(spark, texts, ids=None, lang="en"):
    """A documents table with extra columns whose names clash with internal ones."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 7, "x", True, "r", 1) for i, t in zip(ids, texts)], SCHEMA)


#: Null, empty, blank, short, repeated, tied and long texts.
ODD = [None, "", " \t\n ", "a", "a b", "A  B", "a b", "x" * 5000, "é ü 1", "word " * 3000, "word " * 3000, "1 2 3", "Ünï ©" * 400]
