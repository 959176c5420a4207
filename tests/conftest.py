import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wirestar.session import local_session  # noqa: E402
from wirestar.sources.staging import Staging  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "wirestar-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    with Staging(spark) as area:
        yield area


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# Fixed value: the heading of traffic files.
HEADER = "User,Time Stamp,Source IP,Destination IP,KB Bandwidth,Total KB Bandwidth\n"

PACKET_SCHEMA = (
    "user_name string, time_stamp timestamp_ntz, source_ip string, destination_ip string,"
    " bandwidth_kb float"
)
HOUR_SCHEMA = (
    "time_hour timestamp_ntz, user_name string, source_ip string, destination_ip string,"
    " bandwidth_kb_sum double"
)
USER_SCHEMA = (
    "user_key int, user_name string, local_ip string, start_date timestamp_ntz,"
    " end_date timestamp_ntz, current_flag boolean"
)


def rows(df, *columns):
    """Rows as tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
