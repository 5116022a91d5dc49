from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import local_test_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_test_session("tessera-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-tests-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint directory."""
    from tessera.session import scratch_root
    return tempfile.mkdtemp(prefix="t-", dir=scratch_root(spark).removeprefix("file:"))


@pytest.fixture(scope="session")
def warehouse_sf0001(spark):
    """The sf0.001 warehouse, built once for the session."""
    from tessera.plans.queries import warehouse
    return warehouse(spark, SF0001)
