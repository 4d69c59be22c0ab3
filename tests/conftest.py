import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    s = build_session(4, app="strata-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collect selected columns as a list of tuples (small test frames only)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
