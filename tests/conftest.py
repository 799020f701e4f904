import uuid

import pytest

from martkit.session import local_session, shared_folder


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def name():
    """A table name no other test uses."""
    return f"t_{uuid.uuid4().hex[:12]}"
