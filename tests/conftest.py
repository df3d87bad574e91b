import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ringwatch.session import get_spark  # noqa: E402
from ringwatch.sources.transfers import TRANSFER_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="ringwatch-tests", shuffle_partitions=4)
    yield s


def ts(h: float = 0, day: int = 1) -> dt.datetime:
    return dt.datetime(2022, 9, day) + dt.timedelta(hours=h)


def transfer(txn_id, when, frm, to, amount=100.0, label=0, from_bank="001", to_bank="002",
             received=None, rc="US Dollar", pc="US Dollar", fmt="ACH"):
    return (txn_id, when, from_bank, frm, to_bank, to, amount if received is None else received, rc, amount, pc,
            fmt, label)


@pytest.fixture
def make_transfers(spark):
    def make(rows):
        return spark.createDataFrame(rows, TRANSFER_SCHEMA)
    return make
