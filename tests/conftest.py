import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("STARKIT_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from starkit.session import get_session

    s = get_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the shared checkpoint location."""
    from starkit.sources.export import run_folder

    return run_folder(spark, "test")
