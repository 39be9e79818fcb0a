import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or longer rows."""

    def run(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)

    return run
