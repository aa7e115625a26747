import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if folder not in sys.path:
        sys.path.insert(0, folder)

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=8, shuffle_partitions=4, name="tests", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES
