import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from logflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def shared_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_dir):
    settings = {"spark.checkpoint.dir": shared_dir + "/"}
    session = local_session(8, shuffle_partitions=4, memory="6g", settings=settings)
    yield session
    session.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "log")
