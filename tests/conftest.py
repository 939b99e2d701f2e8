import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", 4, **{"spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples, nulls first."""

    def get(df):
        def key(v):
            return (v is not None, str(type(v)), str(v))

        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(key, r)))

    return get
