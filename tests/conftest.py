import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recordmill.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from recordmill.session import scratch_dir

    return scratch_dir(spark, "test")
