from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from spendlens.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def data_dir():
    return str(DATA / "sf0.01")


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema; text months become dates, numbers amounts."""
    def build(schema: str, *rows):
        def value(v):
            if isinstance(v, str) and len(v) == 7 and v[4] == "-" and v[:4].isdigit():
                return date(int(v[:4]), int(v[5:]), 1)
            return Decimal(str(v)) if isinstance(v, float) and "decimal" in schema else v
        return spark.createDataFrame([tuple(value(v) for v in row) for row in rows], schema)
    return build
