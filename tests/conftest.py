import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rollcall.config import apply_session_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rollcall-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield apply_session_settings(session)
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a Column function over a list of inputs, in order."""

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v")).alias("r")).collect()]

    return run


PERSON_SCHEMA = (
    "id string, name string, email string, age int, city string, status string, createdAt string"
)


def person_row(n=1, **changes):
    row = {
        "id": f"00000000-0000-4000-8000-{n:012d}",
        "name": f"Person {n}",
        "email": f"user{n}@test.com",
        "age": 30,
        "city": "Paris",
        "status": "Active",
        "createdAt": "2024-01-01T00:00:00Z",
    } | changes
    return tuple(row.values())


@pytest.fixture
def people(spark):
    """Storage rows from keyword changes, numbered from one."""

    def make(*changes):
        rows = [person_row(i + 1, **c) for i, c in enumerate(changes)]
        return spark.createDataFrame(rows, PERSON_SCHEMA)

    return make
