from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tablework.session import pin_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "6g")
               .config("spark.checkpoint.dir", "file:" + str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield pin_session(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
