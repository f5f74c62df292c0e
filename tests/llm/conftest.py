"""Small tables for the operators on training data."""

import pytest
from odd_rows import DOCUMENT, SF, awkward
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd_docs(spark):
    """With an extra column and one whose name the operators use themselves."""
    frame = spark.createDataFrame(awkward(), DOCUMENT)
    return frame.withColumns({"key": F.lit("mine"), "label": F.lit(7), "fp": F.lit(1), "pii_text": F.lit("z"), "size": F.lit("big")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
