from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from queuelens.session import build_session

    s = build_session("local[4]", app="queuelens-tests", shuffle_partitions=4)
    # Tests only: a private checkpoint folder when the session names none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="queuelens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_star(spark):
    from queuelens.plans.model import materialized_star

    return materialized_star(spark, SF_SMALL)


def explain_text(df, mode: str = "simple") -> str:
    """The physical plan as text, through the public ``DataFrame.explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
