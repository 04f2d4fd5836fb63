import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from headway.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
            ),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
