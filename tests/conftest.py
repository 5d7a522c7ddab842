import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from labelmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """The value of an expression over one row of given columns."""

    def run(make, *values, schema=None):
        from pyspark.sql import functions as F

        names = [f"c{i}" for i in range(len(values))]
        df = spark.createDataFrame([tuple(values)], schema or ", ".join(f"{n} string" for n in names))
        return df.select(make(*[F.col(n) for n in df.columns]).alias("v")).first()["v"]

    return run
