import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from siftwell.runtime import local_session

    session = local_session("4", "4g", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
