import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tallymark.config import Settings  # noqa: E402
from tallymark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Without the fallback a plan too large to compile fails instead of running slowly.
    session = build_session("tests", cpus=8, spark__sql__codegen__fallback="false", spark__sql__shuffle__partitions="4",
                            spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    yield session
    session.stop()


@pytest.fixture
def settings():
    return Settings(as_of=datetime(2025, 9, 1, 12), key_buckets=4)
