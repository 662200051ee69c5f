import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from billing_guard.session import build_session, work_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(app_name="billing_guard_tests", master="local[*]",
                            shuffle_partitions=8)
    work_root(session)  # tests get a private work folder when none is configured
    yield session
    session.stop()
