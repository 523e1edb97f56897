import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from couponlens.session import build_session
    scratch = tempfile.mkdtemp(prefix="couponlens-test-")
    s = build_session("local[*]", 8, app="couponlens-tests", extra={
        "spark.checkpoint.dir": scratch, "spark.local.dir": scratch})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from check_oracle import duck as connect
    return connect(SMALL)


def receipts_df(spark, rows):
    """Hand-made receipts: (user, merchant, coupon, rate, distance, received, used)."""
    import datetime as dt
    from couponlens.sources.receipts import RECEIPT_SCHEMA

    def d(x):
        return dt.date.fromisoformat(x) if isinstance(x, str) else x
    return spark.createDataFrame([(u, m, c, r, dist, d(rec), d(used)) for u, m, c, r, dist, rec, used in rows],
                                 RECEIPT_SCHEMA)
