import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from votestream.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, partitions=4)
    yield session
    session.stop()


@pytest.fixture(params=["sf0.001", "sf0.01"])
def sf_dir(request):
    folder = TESTDATA / request.param
    if not folder.exists():
        pytest.skip(f"no tables in {folder}")
    return str(folder)
