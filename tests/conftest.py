import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("rainpanel-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rainpanel-checkpoint-"))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Collected rows as tuples, sorted."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
