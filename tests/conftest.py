import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tierwise.schemas import source_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tierwise-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierwise-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tierwise-test-", dir="/tmp")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def src_df(spark, rows):
    """Source rows: (id, customerId, lastStatus, posOrigin, posDestination, createdAt, updatedAt, deletedAt)
    with timestamps given as text."""
    conv = [
        tuple(ts(v) if (i >= 5 and isinstance(v, str)) else v for i, v in enumerate(r)) for r in rows
    ]
    return spark.createDataFrame(conv, source_schema(T.TimestampNTZType()))
