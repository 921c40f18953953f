from __future__ import annotations

import pytest

from meterline.session import build_session

LOCAL = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "4",
    "spark.sql.catalogImplementation": "in-memory",
    "spark.driver.memory": "6g",
    # Plans are read as text, and expression numbers grow during a run.
    "spark.sql.maxMetadataStringLength": "10000",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "meterline-tests",
        master="local[8]",
        **LOCAL,
        **{
            "spark.checkpoint.dir": f"{folder}/checkpoints",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
