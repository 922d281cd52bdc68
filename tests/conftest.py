import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from procura.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="procura-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="procura-test-wh-")})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="procura-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def source_root(spark, tmp_path_factory):
    """The source relations of the smallest test tables, stored once."""
    from procura.sources.catalog import export_sources
    from procura.sources.testdata import TestSources
    root = str(tmp_path_factory.mktemp("sources"))
    export_sources(TestSources(spark, SMALL), root)
    return root
