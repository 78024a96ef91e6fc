import pytest

#: Cases every operator takes: null, empty, blank, short, repeated, long.
TEXTS = [None, "", " \n\t ", "one", "One two three.", "One two three.", "word " * 3000, "x" * 30000, "日本語 – é 😀\nline two is here.\n\nline four."]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "clash", 1.5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "clash", 2.5), (None, "no id here", "clash", None), (99, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, n_words double")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables as the driver lays them out."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/data/{name}.parquet")
        return f"{tmp_path}/data"

    return write
