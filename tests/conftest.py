import pytest

from quarrymill.plans.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4, 4)
    yield session
    session.stop()


@pytest.fixture
def big(monkeypatch):
    """Join as if no table were within the broadcast limits."""
    from quarrymill.plans import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
