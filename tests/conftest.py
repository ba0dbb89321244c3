import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from mktlens.operators.joins import _match  # noqa: E402
from mktlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="mktlens-tests")
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or df.columns
    def key(t):
        return tuple((0, 0) if x is None else (1, x) for x in t)
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=key)


def wildcard_join_nested(left, right, text, name, how="left", wildcards=False):
    """``wildcard_join`` as a nested loop: the brute-force form."""
    return left.join(right, _match(F.lower(left[text]), F.lower(right[name]), wildcards), how)
