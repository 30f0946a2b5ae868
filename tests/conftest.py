import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pricetide.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("pricetide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def feed(spark):
    """Raw rows from partial dictionaries; unset cells take a valid default."""
    defaults = dict(
        zip(
            RAW_COLUMNS,
            ["p1", "name", "brand", "cat", "1.00", "2.00", "USD", "2020-01-01", "shop", "new"],
        )
    )

    def build(*rows):
        data = [tuple({**defaults, **row}[c] for c in RAW_COLUMNS) for row in rows]
        return spark.createDataFrame(data, RAW_SCHEMA)

    return build
