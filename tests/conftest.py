import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from curvemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, **{"spark.checkpoint.dir": str(folder)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Literal rows without the removal of duplicates."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
