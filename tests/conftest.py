import os
import sys
import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from cdclake.sources.lake import Lake, init_namespaces

    lake = Lake(
        spark, root=str(tmp_path / "lake"), prefix=f"t_{uuid.uuid4().hex[:8]}_", state_buckets=4
    )
    init_namespaces(lake)
    return lake


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
