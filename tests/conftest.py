import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwise.session import get_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    # test tables go to a scratch warehouse, not into the working directory
    warehouse = tempfile.mkdtemp(prefix="tickwise-warehouse-")
    s = get_session("local[4]", shuffle_partitions=4, app_name="tickwise-tests",
                    extra={"spark.sql.warehouse.dir": warehouse})
    shared_dir(s)   # registers a private folder only when spark.checkpoint.dir is unset
    yield s
    s.stop()


TICK_DDL = "symbol string, timestampvalue string, price double, volume int, tick_id long"


@pytest.fixture
def make_ticks(spark):
    def make(rows):
        return spark.createDataFrame(rows, TICK_DDL)
    return make
