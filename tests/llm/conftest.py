"""Fixtures of the operators' tests."""

from __future__ import annotations

import pytest
from llm_data import SCHEMA, awkward

from keyfold.llm.common import workers_find_package


@pytest.fixture(scope="session")
def docs(spark):
    workers_find_package(spark)
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    workers_find_package(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The given documents table at the smallest size."""
    workers_find_package(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
