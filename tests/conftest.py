import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALLEST = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    from larder.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def lines(spark):
    """Rows of one text column ``line`` from Python values or raw text."""
    import json

    def make(*docs):
        return spark.createDataFrame(
            [(d if isinstance(d, str) else json.dumps(d),) for d in docs], "line string"
        )

    return make
