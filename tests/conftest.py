import pytest

from tidewell import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = session.local(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh"))})
    session.ship(s)
    return s
