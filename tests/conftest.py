import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from boardlens.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, checkpoint_dir=tempfile.mkdtemp(prefix="spark-"))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    ship_package(session)
    yield session
    session.stop()
