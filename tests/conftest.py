import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pagequarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_ui_enabled="false",
        spark_sql_shuffle_partitions="4",
        spark_driver_memory="6g",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a Column function over a list of strings."""
    from pyspark.sql import functions as F

    def run(function, values):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "i int, t string").repartition(4)
        return [r.x for r in frame.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]

    return run
