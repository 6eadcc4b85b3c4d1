import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from recordlake.session import lake_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def base_spark():
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("recordlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def spark(base_spark):
    return lake_session(base_spark)


@pytest.fixture
def json_df(spark, tmp_path):
    """A DataFrame inferred from JSON objects written as one NDJSON file."""
    count = iter(range(1000))

    def build(*records):
        path = tmp_path / f"records-{next(count)}.ndjson"
        path.write_text("\n".join(json.dumps(r) for r in records) + "\n")
        return spark.read.json(str(path))

    return build
