import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIX = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from evtlens.session import get_spark
    s = get_spark("local[4]", 4, app_name="evtlens-tests")
    yield s
    s.stop()


def fixture_path(name: str) -> str:
    return os.path.join(FIX, name)


@pytest.fixture(scope="session")
def order_log(spark):
    from evtlens.sources.text import read_order_events, with_arrival_seq
    return with_arrival_seq(read_order_events(spark, fixture_path("OrderLog.csv")).coalesce(1))


@pytest.fixture(scope="session")
def receipt_log(spark):
    from evtlens.sources.text import read_receipts
    return read_receipts(spark, fixture_path("ReceiptLog.csv"))


@pytest.fixture(scope="session")
def login_log(spark):
    from evtlens.sources.text import read_logins, with_arrival_seq
    return with_arrival_seq(read_logins(spark, fixture_path("LoginLog.csv")).coalesce(1))


@pytest.fixture(scope="session")
def login_log48(spark):
    from evtlens.sources.text import read_logins, with_arrival_seq
    return with_arrival_seq(read_logins(spark, fixture_path("LoginLog48.csv")).coalesce(1))


@pytest.fixture(scope="session")
def ad_clicks(spark):
    from evtlens.sources.text import read_ad_clicks, with_arrival_seq
    return with_arrival_seq(read_ad_clicks(spark, fixture_path("AdClickLog.csv")).coalesce(1))
