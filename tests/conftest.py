import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rootlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("rootlens-tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


@pytest.fixture
def rows(spark):
    """Rows of a frame as dicts, ordered by the given columns."""

    def read(df, *order):
        return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]

    return read
