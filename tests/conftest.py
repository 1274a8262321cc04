import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("payloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def bronze(spark):
    """Build a bronze frame from (element, payload json, l0 json, from, at) tuples."""
    def make(rows):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        df = spark.createDataFrame(full, "l1element string, p string, l0 string, ingested_from string, at string")
        return df.selectExpr(
            "coalesce(ingested_from, 'src_1_2024') AS ingested_from",
            "to_timestamp(coalesce(at, '2024-01-01 00:00:00')) AS ingested_at",
            "try_parse_json(l0) AS l0payload", "l1element", "try_parse_json(p) AS payload")
    return make
