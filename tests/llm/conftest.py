"""Fixtures of the training-data tests."""

import pytest
from odd_rows import CLASHES, SCHEMA, odd_rows
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """The same rows with further columns named like the operators' own."""
    schema = T.StructType(SCHEMA.fields + [T.StructField(c, T.StringType()) for c in CLASHES])
    return spark.createDataFrame([r + tuple("x" for _ in CLASHES) for r in odd_rows()], schema)
