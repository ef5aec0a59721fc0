import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorepipe.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    os.chdir(folder)  # the warehouse of the test tables
    s = local_session(os.environ.get("TEST_CPUS", "8"), 4)
    s.sparkContext.setCheckpointDir(str(folder / "shared"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def gold(spark):
    from scorepipe.queries.base import gold as build

    g = build(spark, MEDIUM).persist()
    g.count()
    return g


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)
