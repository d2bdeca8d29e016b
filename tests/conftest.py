from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cohortlens.session import checkpoint_dir, configure
    s = (SparkSession.builder.master("local[*]").appName("cohortlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck001():
    from tools.oracle_check import duck_connection
    return duck_connection(SF001)


@pytest.fixture(scope="session")
def duck01():
    from tools.oracle_check import duck_connection
    return duck_connection(SF01)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cohortlens-test-")
