import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfstream.session import configure_session  # noqa: E402

SF_FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("shelfstream-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure_session(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_FOLDER


@pytest.fixture(scope="session")
def rows(spark):
    """rows(schema, tuple, tuple, …) with ISO texts for zone-free timestamps."""
    def make(schema, *data):
        columns = [part.strip().split(" ", 1) for part in schema.split(",")]
        texts = [(n, "string" if t in ("timestamp_ntz", "date") else t) for n, t in columns]
        df = spark.createDataFrame(list(data), ", ".join(f"{n} {t}" for n, t in texts))
        return df.selectExpr(*[f"CAST({n} AS {t}) AS {n}" if t in ("timestamp_ntz", "date") else n for n, t in columns])

    return make
