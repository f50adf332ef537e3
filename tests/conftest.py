import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from playstream.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", app_name="playstream-tests", shuffle_partitions=8)
    # tests only: a private folder when the session names none
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="ps-ckpt-"))
    yield s
    from playstream.session import drop_scratch
    drop_scratch(s)
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ps-test-")
