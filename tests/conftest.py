import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tools"):
    sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import local_session

    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    from eventloom.sources.tables import Tables

    return Tables(spark, str(tmp_path / "lake"))
