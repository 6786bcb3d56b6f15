import pytest


@pytest.fixture
def docs_df(spark):
    """Documents with columns that clash with what operators add."""
    def make(rows, more="n_words long, kept boolean, row_key string, label int"):
        return spark.createDataFrame([(d, t, None, None, None, None) for d, t in rows],
                                     f"doc_id long, text string, {more}")
    return make
