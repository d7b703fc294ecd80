import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(helpers.rows(), helpers.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], helpers.SCHEMA)
