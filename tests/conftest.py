import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from ledgerlake.session import build_session
    warehouse = tempfile.mkdtemp(prefix="ledgerlake-warehouse-")
    s = build_session("local[4]", 4, app_name="ledgerlake-tests",
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
