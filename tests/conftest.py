import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillstream.session import local_session  # noqa: E402
from tillstream.sources.keyed import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    return Store(spark, name, str(tmp_path / "store"), buckets=4).ensure()
