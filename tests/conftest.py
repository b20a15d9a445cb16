import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from codequarry.session import prepare

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture
def value(spark):
    """Evaluate a column expression over one string value ``v``."""

    def evaluate(build, text):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(text,)], "v string").select(build(F.col("v"))).first()[0]

    return evaluate


@pytest.fixture
def column(spark):
    """Evaluate a column expression over many string values ``v``, in order."""

    def evaluate(build, values):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        found = rows.select("i", build(F.col("v")).alias("r")).collect()
        return [row.r for row in sorted(found, key=lambda row: row.i)]

    return evaluate
