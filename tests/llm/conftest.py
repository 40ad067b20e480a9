import pytest
from llm_fixtures import SCHEMA, awkward_texts


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_texts(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
