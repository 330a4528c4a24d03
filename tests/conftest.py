import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from shelfline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "shelfline-tests", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    from shelfline.session import shared_dir
    shared_dir(session)
    yield session
    session.stop()
