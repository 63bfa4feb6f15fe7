import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lotline.session import local_session
    s = local_session("*", 4, app="lotline-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, 0 if x is None else x) for x in t))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
