import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from statmart.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # build_session keeps a configured spark.checkpoint.dir and picks a
    # temporary one only when none is set.
    s = build_session("local[4]", app="statmart-tests", shuffle_partitions=4)
    yield s
    s.stop()


def plan_text(df) -> str:
    """The formatted physical plan (as ``explain("formatted")`` prints it)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t)) if order is None else out
