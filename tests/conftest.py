import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from weekcast.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8, app="weekcast-tests")
    yield s


SCHEMA_SALES = ("store_id long, product_id long, txn_date date, quantity double, gross_value double, "
                "net_value double, gross_profit double, discount double, taxes double")
