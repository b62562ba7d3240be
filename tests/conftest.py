import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from revflow.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="revflow-tests")
    yield s


@pytest.fixture()
def scratch(spark):
    from revflow.session import scratch_path

    return scratch_path(spark, "test")
