import pytest

from quillframe.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("spark"))
    session = local_session(8, spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=folder)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def tiny_segments(monkeypatch):
    """Every group counts as hot and is cut into segments of three rows."""
    from quillframe.plans import groups

    monkeypatch.setattr(groups, "LARGEST_PLAIN_GROUP", 0)
    monkeypatch.setattr(groups, "SEGMENT_ROWS", 3)
