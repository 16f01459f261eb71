from __future__ import annotations

import os

import pytest

from fieldloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"}
    session = build_session("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
