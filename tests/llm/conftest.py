import pytest
from samples import SCHEMA, SF, as_docs, edge_texts


@pytest.fixture(scope="session")
def edges(spark):
    return as_docs(spark, edge_texts())


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
