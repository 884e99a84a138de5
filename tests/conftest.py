import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from atomweft.session import get_session

    session = get_session("tests", master="local[8]", shuffle_partitions=8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.local.dir": str(tmp_path_factory.mktemp("local"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
