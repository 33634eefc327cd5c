import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from optlake.session import prepare_session

    builder = (SparkSession.builder.master("local[4]").appName("optlake-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="optlake-ck-"))
    prepare_session(s)
    yield s
