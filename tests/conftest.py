from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from headway import schemas
from headway.session import build_session

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"
AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        **{
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="headway-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="headway-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text: str | None) -> dt.datetime | None:
    """'10 08:30' is 08:30 on 10 January 2024."""
    return None if text is None else dt.datetime.strptime(f"2024-01-{text}", "%Y-%m-%d %H:%M")


TRIP_ROW = {
    "ingested_at": moment("10 08:20"),
    "feed_timestamp": moment("10 08:19"),
    "source": "test",
    "entity_id": "e1",
    "trip_id": "t1",
    "route_id": "r1",
    "start_date": "20240110",
    "start_time": "08:00:00",
    "stop_id": "s1",
    "stop_sequence": 1,
    "event_type": "ARRIVAL",
    "event_time": moment("10 08:30"),
    "delay_sec": 100,
    "schedule_relationship": "0",
    "raw_json": None,
}
PING_ROW = {
    "ingested_at": moment("10 08:20"),
    "feed_timestamp": moment("10 08:19"),
    "source": "test",
    "entity_id": "e1",
    "vehicle_id": "v1",
    "trip_id": "t1",
    "route_id": "r1",
    "position_lat": 37.5,
    "position_lon": -122.25,
    "bearing": 90.0,
    "speed": 10.0,
    "current_status": "2",
    "current_stop_sequence": 1,
    "stop_id": "s1",
    "timestamp": moment("10 08:15"),
    "raw_json": None,
}


def _rows(spark, ddl, template, changes):
    schema = schemas.struct(ddl)
    full = [{**template, **{k: moment(v) if k in TIMES else v for k, v in c.items()}} for c in changes]
    return spark.createDataFrame([tuple(row[f] for f in schema.fieldNames()) for row in full], schema)


TIMES = {"ingested_at", "feed_timestamp", "event_time", "timestamp"}


@pytest.fixture
def trip_rows(spark):
    """Raw trip rows that differ from TRIP_ROW in the given fields."""
    return lambda *changes: _rows(spark, schemas.RAW_TRIP_UPDATES, TRIP_ROW, changes)


@pytest.fixture
def ping_rows(spark):
    return lambda *changes: _rows(spark, schemas.RAW_VEHICLE_POSITIONS, PING_ROW, changes)


def as_set(df, *columns):
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    unique = set(rows)
    assert len(unique) == len(rows), "duplicate rows"
    return unique
