import pytest

from tidelog.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("shared")
    return local_session(8, "tests", **{"spark.checkpoint.dir": str(base), "spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
