import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, HERE)
# Python workers import the package too, wherever pytest is started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column_of(spark):
    """Evaluate a column builder over a list of texts."""

    def evaluate(values, build, ddl="STRING"):
        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, f"i INT, v {ddl}")
        from pyspark.sql import functions as F

        out = df.select("i", build(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(out, key=lambda r: r["i"])]

    return evaluate
