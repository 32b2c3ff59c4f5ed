import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pricelode.session import get_session

    return get_session("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})


@pytest.fixture(scope="session")
def root():
    return "/root/testdata/sf0.001"
