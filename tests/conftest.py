import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("runnel-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sites(spark):
    """Build a site table from partial rows; every other column is 0."""
    from runnel.schema import SITE_COLUMNS, SITE_SCHEMA

    def make(*rows):
        return spark.createDataFrame([tuple(r.get(c, 0.0) for c in SITE_COLUMNS) for r in rows], SITE_SCHEMA)

    return make


def months(prefix, values):
    from runnel.schema import MONTHS

    return {f"{prefix}_{m}": float(v) for m, v in zip(MONTHS, values)}
