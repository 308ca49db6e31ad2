from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheaf.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Only local tests set their own checkpoint folder (a cluster names one).
    os.environ.setdefault("SHEAF_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="sheaf-test-ck-"))
    s = get_session("local[4]", app="sheaf-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="sheaf-test-")


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples of ``cols`` (all columns when empty)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
