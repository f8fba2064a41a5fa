import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("evenkeel-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        # many short jobs: start-up time of generated code is what counts here
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows_from_counts(spark):
    """A table with given (group, n, positives) counts, one row per person."""

    def build(counts, sensitive="sensitive_attr", target="target"):
        rows = [
            (g, 1 if i < positives else 0) for g, n, positives in counts for i in range(n)
        ]
        return spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], f"id long, {sensitive} string, {target} int"
        )

    return build
