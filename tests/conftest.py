import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import build_session

# The published extract is no part of the repository.
if not (os.environ.get("LEDGERLOOM_MASTERS") and os.environ.get("LEDGERLOOM_PAGES")):
    collect_ignore = ["test_published.py"]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerloom-tests",
        master="local[4]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()
