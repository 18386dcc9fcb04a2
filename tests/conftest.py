import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from vacancylab.session import DEFAULT_CONF, ensure_checkpoint_dir, ship_package
    b = (SparkSession.builder.master("local[*]").appName("vacancylab-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="vacancylab-test-ckpt-"))
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vacancylab-test-")


class Tables:
    """Minimal JobTables stand-in for hand-made fixtures."""

    def __init__(self, **kw):
        for k in ("postings", "positions", "employers", "regions", "ai_tags", "tech_tags"):
            setattr(self, k, kw.get(k))
