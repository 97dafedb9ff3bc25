from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import local_session
    s = local_session("*", 8, app="vigil-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from vigil.session import scratch_path
    return scratch_path(spark, "test").removeprefix("file:")


def readings(spark, rows, with_arrival=True):
    """Build a telemetry frame from dicts (missing keys -> NULL), in arrival order."""
    from vigil.sources import schemas
    fields = [f.name for f in schemas.TELEMETRY.fields]
    data = []
    for i, r in enumerate(rows):
        d = {"arrival_seq": i, "event_id": f"evt-{i}", "device_id": "MTR-001",
             "event_timestamp": "2026-09-13T18:30:00Z", "temperature": 60.0, "pressure": 4.0, "vibration": 3.0,
             "rpm": 1500, "status": "RUNNING"}
        d.update(r)
        data.append(tuple(d.get(f) for f in fields))
    df = spark.createDataFrame(data, schemas.TELEMETRY)
    return df if with_arrival else df.drop("arrival_seq")
