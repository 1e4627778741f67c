import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from crowding.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="crowding-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from crowding.plans.inputs import Inputs

    return Inputs(spark, SF_SMALL)
