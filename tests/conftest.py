from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tillflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, shuffle_partitions=4, scratch_dir=str(tmp_path_factory.mktemp("scratch")))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
