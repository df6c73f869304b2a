from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import SF_DIR, duck, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))
