import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    folder = tempfile.mkdtemp(prefix="millrace-tests-")
    session = local_session(4, partitions=4, settings={"spark.sql.warehouse.dir": f"{folder}/warehouse"})
    yield session
    session.stop()


@pytest.fixture
def tables():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Collect as a sorted list of plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
