import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clientele.session import build_session

    session = build_session("local[8]", app_name="clientele-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """The canonical tables as stored tables, as production has them."""
    from clientele.sources.fixtures import stored_tables

    return stored_tables(spark, SF01, str(tmp_path_factory.mktemp("stored")))
