import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sectorlens.session import configure  # noqa: E402


def make_session() -> SparkSession:
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("sectorlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.local.dir", f"{work}/local")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
