import pytest

from monthbook.session import build_session
from tests.compare import duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SMALL)
