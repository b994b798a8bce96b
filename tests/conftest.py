import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from flowlens.schemas import LOG_SCHEMA  # noqa: E402

SF_SMALL = os.environ.get("FLOWLENS_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from flowlens.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def conn_row(ts, orig="10.0.0.1", orig_p=1000, resp="203.0.0.1", resp_p=80, proto="tcp", service="http",
             duration=1.0, uid=None, **kw):
    base = {c.name: None for c in LOG_SCHEMA.fields}
    base.update(TIPO="CONN", TS=ts, TS_CODE=ts + dt.timedelta(seconds=5), UID=uid or f"C{ts.timestamp()}{orig}{orig_p}",
                ID_ORIG_H=orig, ID_ORIG_P=orig_p, ID_RESP_H=resp, ID_RESP_P=resp_p, PROTO=proto,
                SERVICE=service, DURATION=duration, ORIG_BYTES=10, RESP_BYTES=20, ORIG_PKTS=1,
                ORIG_IP_BYTES=40, RESP_PKTS=1, RESP_IP_BYTES=60)
    base.update(kw)
    return base


@pytest.fixture
def make_log(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r[c.name] for c in LOG_SCHEMA.fields) for r in rows], LOG_SCHEMA)

    return make
