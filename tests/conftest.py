from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstream.schema import BEHAVIOR  # noqa: E402
from shopstream.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# The five sample messages of the activity topic
# (2023-11-14 22:13:20..24 UTC), as published.
SAMPLE_MESSAGES = [
    '{"user_id":"u_1001","item_id":"i_5002","category_id":"c_301","behavior_type":"click","quantity":0,"amount":0,"timestamp":1700000000000,"session_id":"s_abc123"}',
    '{"user_id":"u_1002","item_id":"i_5003","category_id":"c_302","behavior_type":"cart","quantity":0,"amount":0,"timestamp":1700000001000,"session_id":"s_abc124"}',
    '{"user_id":"u_1003","item_id":"i_5004","category_id":"c_303","behavior_type":"buy","quantity":2,"amount":99.90,"timestamp":1700000002000,"session_id":"s_abc125"}',
    '{"user_id":"u_1004","item_id":"i_5005","category_id":"c_304","behavior_type":"fav","quantity":0,"amount":0,"timestamp":1700000003000,"session_id":"s_abc126"}',
    '{"user_id":"u_1005","item_id":"i_5006","category_id":"c_305","behavior_type":"click","quantity":0,"amount":0,"timestamp":1700000004000,"session_id":"s_abc127"}',
]


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app_name="shopstream-tests", shuffle_partitions=4)
    yield s
    s.stop()


def behavior_df(spark, records):
    return spark.createDataFrame(records, schema=BEHAVIOR)


def messages_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
