import os

import pytest


@pytest.fixture(scope="session")
def testdata():
    return os.environ.get("TIDEWELL_TESTDATA", "/root/testdata")
