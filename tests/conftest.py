import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldreports.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="fieldreports-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster setting: use a scratch folder of our own.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="fr-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fr-test-")
