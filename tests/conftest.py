import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a ``Column -> Column`` function over a list of values."""
    from pyspark.sql import functions as F

    def run(function, values, schema="v string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, " + schema)
        out = rows.select("i", function(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(out, key=lambda r: r["i"])]

    return run
