import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import ODD, ODD_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
