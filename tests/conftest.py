import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from clauseworks.session import local_session

    session = local_session("tests", cpus=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
