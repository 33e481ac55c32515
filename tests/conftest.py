import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from gradeloom.session import build_session

    s = build_session("tests", "local[4]", 4, {"spark.driver.host": "127.0.0.1", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/gradeloom-warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
