import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from adcube.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("adcube-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)  # keeps a configured spark.checkpoint.dir
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="adcube-test-")
