from __future__ import annotations

import pytest

from proofmark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", "tests", {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
