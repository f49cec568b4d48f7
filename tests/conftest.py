import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from applytrail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to a list of texts and collect the results."""
    from pyspark.sql import functions as F

    def run(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]
    return run
