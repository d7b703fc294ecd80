import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def users(spark):
    """Nine rows of two users, one value missing."""
    rows = [
        (1, 1, 30, "A"),
        (2, 1, 40, "B"),
        (3, 1, None, "A"),
        (4, 1, 30, "A"),
        (5, 1, 50, "B"),
        (6, 1, 20, "A"),
        (7, 2, 30, "B"),
        (8, 2, 30, "B"),
        (9, 2, 30, "B"),
    ]
    return spark.createDataFrame(rows, "seq bigint, user_id bigint, age int, city string")


@pytest.fixture(scope="session")
def in_order():
    """The values of a column by ``seq``."""

    def values(df, column):
        return [r[column] for r in df.select("seq", column).orderBy("seq").collect()]

    return values
