from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMOKE_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tally.session import ensure_checkpoint_dir, local_session
    s = local_session(cores=4, shuffle_partitions=8, app="tally-tests")
    ensure_checkpoint_dir(s)
    yield s


def rows(df, *cols):
    """Collected rows as plain tuples (optionally a column subset), sorted."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
