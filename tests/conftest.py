import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from attesta import scale  # noqa: E402
from attesta.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def tiny_blocks(spark):
    """Every group above three rows is treated as a large one."""
    spark.conf.set(scale.ROWS_PER_BLOCK, "3")
    yield
    spark.conf.unset(scale.ROWS_PER_BLOCK)


@pytest.fixture(params=["plain", "large"])
def blocks(request, spark):
    """Runs a test with ordinary groups and again with every group cut into blocks."""
    if request.param == "large":
        spark.conf.set(scale.ROWS_PER_BLOCK, "3")
    yield request.param
    spark.conf.unset(scale.ROWS_PER_BLOCK)
