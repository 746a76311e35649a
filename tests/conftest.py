import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from medallion.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("m"))


def lines_df(spark, rows):
    """rows: list of (value, file)."""
    return spark.createDataFrame(rows, "value string, _source_file string")


def env(event_id, event_type, ts, payload):
    import json

    return json.dumps(
        {"event_id": event_id, "event_type": event_type, "event_timestamp": ts,
         "event_version": "1.0", "payload": payload},
        separators=(",", ":"),
    )
