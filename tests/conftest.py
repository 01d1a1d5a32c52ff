from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from routecast.session import build_session

    s = build_session("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="routecast-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def wh(spark):
    from routecast.plans.warehouse import warehouse_for

    return warehouse_for(spark, SF_SMALL)
