import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or whole rows, with a column that clashes with none of ours."""

    def make(*rows, schema=DOCUMENTS):
        filled = [
            row if len(row) > 2 else (row[0], row[1], "en", "src0", len(row[1] or "")) for row in rows
        ]
        return spark.createDataFrame(filled, schema)

    return make


@pytest.fixture
def vectors(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")

    return make
