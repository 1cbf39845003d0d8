import pytest

from docketry.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tests keep their scratch tables to themselves, also where the machine sets a folder.
    session = local_session("4", "tests", str(tmp_path_factory.mktemp("scratch")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
