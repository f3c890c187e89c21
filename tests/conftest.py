import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallywright.session import local_session

    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallywright-tests-"))
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def low_bar(monkeypatch):
    """Keys count as heavy from five rows on, so that small tests take the salted path."""
    from tallywright.operators import joins

    monkeypatch.setattr(joins, "MIN_ROWS", 5)
