import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vecloom.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "4",
        4,
        **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
