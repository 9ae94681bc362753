import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siftloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("4", 4, spark__ui__showConsoleProgress="false",
                            spark__checkpoint__dir=str(folder))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of texts, in order."""
    from pyspark.sql import functions as F

    def apply(fn, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in rows]
    return apply
