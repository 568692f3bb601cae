import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="labelforge-warehouse-")
    shared = tempfile.mkdtemp(prefix="labelforge-shared-")
    s = build_session("local[4]", app="labelforge-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": shared})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns) for comparisons."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
