from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from curvewright.session import local_session

    return local_session("4", shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def stages(spark):
    from curvewright.plans.stages import Stages

    return Stages(spark, SF_DIR)
