import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tilework.session import builder

    root = tmp_path_factory.mktemp("spark")
    more = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
        "spark.sql.warehouse.dir": f"file://{root}/warehouse",
        "spark.checkpoint.dir": f"file://{root}/checkpoints",
    }
    session = builder("tests", **more).master("local[4]").getOrCreate()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
