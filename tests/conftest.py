import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stratal.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    # catalog tables of the tests go to a scratch warehouse, not the repository
    session = build_session("local[*]", 8, app_name="stratal-tests",
                            extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="stratal-wh-")})
    yield session
    session.stop()


@pytest.fixture()
def tmp_out(spark):
    from stratal.session import scratch_path

    return scratch_path(spark, "test")
