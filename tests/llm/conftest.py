import pytest

from cadenza.llm.common import stored


@pytest.fixture
def written(spark, tmp_path):
    """Write tables to a folder laid out as the given ones; returns the folder."""

    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return stored(spark.createDataFrame(full, DOCUMENTS), "documents")

    return make
