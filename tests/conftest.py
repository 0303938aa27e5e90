from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tidemark.session import build_session, cleanup  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    cleanup(session)
    session.stop()
