from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from demandspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("demandspark-tests", cores="*", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
