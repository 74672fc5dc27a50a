import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiweave.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": warehouse,
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
