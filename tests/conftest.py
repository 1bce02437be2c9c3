import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import docsheaf  # noqa: E402
from docsheaf.session import configure  # noqa: E402

cloudpickle.register_pickle_by_value(docsheaf)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield configure(session)
    session.stop()


@pytest.fixture
def texts(spark):
    """Apply a column function to Python strings, in order."""

    def apply(function, values):
        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, "i int, t string")
        out = df.select("i", function(df.t).alias("out")).orderBy("i").collect()
        return [r.out for r in out]

    return apply
