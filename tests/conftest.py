import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from salesloom.context import session


def make_session() -> SparkSession:
    spark = session(
        "salesloom-tests",
        **{
            "spark.master": f"local[{os.environ.get('TEST_CPUS', '8')}]", "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="salesloom-warehouse-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return make_session()
