import pytest

from rowgate.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "rowgate-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write one file of a load and return its folder."""

    def write(text, name="part-0.csv", folder="in"):
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        data = text if isinstance(text, bytes) else text.encode()
        (target / name).write_bytes(data)
        return str(target)

    return write
