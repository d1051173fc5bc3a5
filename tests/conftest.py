import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from voltledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "voltledger-tests",
        master="local[4]",
        spark_sql_shuffle_partitions=4,
        spark_checkpoint_dir=tmp_path_factory.mktemp("shared"),
        spark_sql_warehouse_dir=tmp_path_factory.mktemp("warehouse"),
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
