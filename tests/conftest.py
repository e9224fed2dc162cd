import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hourprofile.session import local_session, scratch_dir
    s = local_session("*", 8)
    scratch_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
