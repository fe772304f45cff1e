import pytest

from riskfeat.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", memory="6g", app="tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
