from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabsmith.session import build_session

    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
