import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tracewater.session import RELIED_ON

    builder = SparkSession.builder.master("local[8]").appName("tests")
    conf = {
        **RELIED_ON,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "tracewater.shared.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows_of(df):
    """Rows as sorted tuples, nulls comparable."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


@pytest.fixture
def rows():
    return rows_of
