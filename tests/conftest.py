import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
