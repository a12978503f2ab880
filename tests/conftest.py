import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from annuity.session import local_session

    scratch = tempfile.mkdtemp(prefix="annuity-tests-")
    session = local_session("*", shuffle_partitions=8,
                            **{"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                               "spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="annuity-run-")
