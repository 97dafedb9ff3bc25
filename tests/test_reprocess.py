"""Reprocessing after a rule change by deltas equals a full run, and touches what changed."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import SF_SMALL, readings
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import analytics, latest
from vigil.plans import refine, reprocess
from vigil.sources import telemetry as tel


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("change", [{"temperature_max": 120.0}, {"temperature_max": 400.0, "temperature_critical": 60.0}, {"vibration_alert": 5.0, "pressure_critical": 6.0}, {}])
def test_deltas_equal_a_full_run(spark, change):
    raw, new = tel.telemetry(spark, SF_SMALL), replace(rules.LIMITS, **change)
    before, after = refine.refined_from(raw), refine.refined_from(raw, new)
    delta = reprocess.rules_delta(raw, rules.LIMITS, new).cache()
    assert rows(reprocess.refined_after(before, delta), *reprocess.ROW) == rows(after, *reprocess.ROW)
    cols = ["device_id", *reprocess.TALLIES]
    assert rows(reprocess.tallies_after(analytics.anomaly_by_device(before), delta), *cols) == rows(analytics.anomaly_by_device(after), *cols)
    status = reprocess.status_after(latest.merge_snapshot(None, before), before, delta)
    assert rows(status, *latest.STATUS_COLUMNS) == rows(latest.merge_snapshot(None, after), *latest.STATUS_COLUMNS)
    old, now = (set(rows(d, *reprocess.ROW)) for d in (before, after))
    assert delta.count() == len(old ^ now)
    delta.unpersist()


def test_another_copy_of_an_id_takes_over(spark):
    """The first copy of an id goes, so its second comes; a device whose only reading goes has no status."""
    raw = readings(spark, [{"event_id": "a", "temperature": 150.0}, {"event_id": "a", "temperature": 50.0}, {"event_id": "b", "device_id": "GONE", "temperature": 160.0}, {"event_id": "c"}, {"event_id": None}])
    new = replace(rules.LIMITS, temperature_max=100.0)
    delta = reprocess.rules_delta(raw, rules.LIMITS, new)
    assert sorted((r.arrival_seq, r.weight) for r in delta.collect()) == [(0, -1), (1, 1), (2, -1)]
    before = refine.refined_from(raw)
    status = reprocess.status_after(latest.merge_snapshot(None, before), before, delta).collect()
    assert [(r.device_id, r.last_arrival_seq) for r in status] == [("MTR-001", 3)]
    assert rows(reprocess.tallies_after(analytics.anomaly_by_device(before), delta), "device_id", "normal_count") == [("MTR-001", 2)]


def test_only_changed_ids_are_refined_again(spark):
    raw = tel.telemetry(spark, SF_SMALL)
    ids = reprocess.changed_ids(raw, rules.LIMITS, replace(rules.LIMITS, temperature_max=199.0))
    near = raw.where(F.col("temperature").between(199.0, 200.0)).select("event_id").distinct()
    assert {r.event_id for r in ids.collect()} <= {r.event_id for r in near.collect()}


def test_readings_are_made_once_and_weights_kept(spark):
    """The comparison does not make the readings' columns anew at each mention, and what uses the weights does not compute them again."""
    raw = tel.telemetry(spark, SF_SMALL)
    new = replace(rules.LIMITS, temperature_critical=60.0, pressure_alert=4.5)
    plan = reprocess.changed_ids(raw, rules.LIMITS, new)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1
    delta = reprocess.rules_delta(raw, rules.LIMITS, new)
    plan = delta._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan and "events" not in plan
    assert not delta.isEmpty()
