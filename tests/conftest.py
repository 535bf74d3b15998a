import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from viewtide.session import build_session  # noqa: E402

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


EVENT_DDL = ("event_id string, session_id string, customer_id string, title_id string, device_id string, "
             "device_version_id string, event_type string, event_timestamp timestamp, server_received_at timestamp, "
             "position_ms int, bitrate_kbps int, geo_country string, schema_version int")


@pytest.fixture
def make_events(spark):
    """Events with sensible defaults; each row overrides some fields."""
    def make(*rows):
        out = []
        for i, row in enumerate(rows):
            ts = row.get("event_timestamp", at("2024-01-10 10:00:00"))
            base = {
                "event_id": f"e{i}", "session_id": "s1", "customer_id": "c1", "title_id": "tt0111161",
                "device_id": "d1", "device_version_id": "d1_v0", "event_type": "play", "event_timestamp": ts,
                "server_received_at": (ts or at("2024-01-10 10:00:00")) + dt.timedelta(seconds=5), "position_ms": 0,
                "bitrate_kbps": 3000, "geo_country": "US", "schema_version": 1}
            base.update(row)
            out.append(tuple(base.values()))
        return spark.createDataFrame(out, EVENT_DDL)
    return make
