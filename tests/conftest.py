from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from verify import duck, session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("4")
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.fixture(scope="session")
def sf():
    return SF
