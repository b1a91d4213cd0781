import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bizlens.session import build_session
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="bizlens-warehouse-")
    s = build_session("local[*]", app="bizlens-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
