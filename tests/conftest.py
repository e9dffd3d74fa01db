import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(partitions: int = 8):
    from pyspark.sql import SparkSession

    from ledgerloom.session import BUILD_SETTINGS, tune

    spark = (
        SparkSession.builder.master("local[8]")
        .config(map=BUILD_SETTINGS)
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerloom-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    return session()
