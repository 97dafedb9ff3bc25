"""Data-quality rules, severity and flags: the source system's unit cases as data, every threshold at / just below /
just above its boundary, NULL / NaN / blank / garbage inputs, and the valid + invalid = input invariant."""

from __future__ import annotations

import math

import pytest
from conftest import readings

from vigil.functions import rules
from vigil.operators import enrich, quality

# (case, overrides, expected codes) -- the source system's own validator cases, then the extra ones
CASES = [
    ("valid", {"temperature": 65.5, "pressure": 4.2, "vibration": 3.1, "rpm": 1500, "status": "RUNNING"}, None),
    ("empty device", {"device_id": ""}, "device_id_null"),
    ("cold", {"temperature": -999.0}, "temperature_out_of_range"),
    ("negative pressure", {"pressure": -5.0}, "pressure_negative"),
    ("bad status", {"status": "EXPLODED"}, "invalid_status"),
    ("null status", {"status": None}, "invalid_status"),
    ("lower-case failure", {"status": "failure"}, "invalid_status"),
    ("null event id", {"event_id": None}, "event_id_null"),
    ("empty event id", {"event_id": ""}, "event_id_null"),
    ("null timestamp", {"event_timestamp": None}, "event_timestamp_null"),
    ("empty timestamp", {"event_timestamp": ""}, "event_timestamp_null"),
    ("garbage timestamp", {"event_timestamp": "yesterday"}, "event_timestamp_invalid"),
    ("offset timestamp", {"event_timestamp": "2026-09-13T18:30:00.123456+00:00"}, None),
    ("null temperature", {"temperature": None}, "temperature_out_of_range"),
    ("NaN temperature", {"temperature": math.nan}, "temperature_out_of_range"),
    ("NaN pressure", {"pressure": math.nan}, "pressure_negative"),
    ("NaN vibration", {"vibration": math.nan}, "vibration_negative"),
    ("null vibration", {"vibration": None}, "vibration_negative"),
    ("null rpm", {"rpm": None}, "rpm_negative"),
    ("negative rpm", {"rpm": -1}, "rpm_negative"),
    ("temperature 0", {"temperature": 0.0}, None),
    ("temperature 200", {"temperature": 200.0}, None),
    ("temperature 200.01", {"temperature": 200.01}, "temperature_out_of_range"),
    ("temperature -0.01", {"temperature": -0.01}, "temperature_out_of_range"),
    ("pressure 0", {"pressure": 0.0}, None),
    ("vibration 0", {"vibration": 0.0}, None),
    ("two failures", {"device_id": None, "status": None}, "device_id_null, invalid_status"),
]


@pytest.fixture(scope="module")
def checked(spark):
    df = readings(spark, [c[1] for c in CASES])
    return {r["arrival_seq"]: r for r in quality.check(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_rule_case(checked, i):
    _, _, expected = CASES[i]
    row = checked[i]
    assert row["error_reason"] == expected
    assert row["is_valid"] is (expected is None)


def test_valid_plus_invalid_is_input(spark):
    df = readings(spark, [c[1] for c in CASES])
    valid, invalid = quality.split(quality.check(df))
    assert valid.count() + invalid.count() == df.count()


def test_null_codes_variant(spark):
    df = readings(spark, [{"temperature": None}, {"pressure": None}, {"vibration": None}, {"rpm": None},
                          {"temperature": 300.0}])
    got = [r["error_reason"] for r in quality.check(df, null_codes=True).orderBy("arrival_seq").collect()]
    assert got == ["temperature_null", "pressure_null", "vibration_null", "rpm_null", "temperature_out_of_range"]


def test_positive_and_failing_forms_agree(spark):
    """is_valid (positive rule forms) must equal "no failing condition" on every case."""
    df = readings(spark, [c[1] for c in CASES])
    out = quality.check(df).selectExpr("is_valid", f"NOT ({' OR '.join(c for _, c in rules.rule_table(df.dtypes))})"
                                                   " AS by_fails").collect()
    assert all(r["is_valid"] == r["by_fails"] for r in out)


# (temperature, pressure, vibration) -> severity: the source system's table, then each boundary
SEVERITY = [
    ((60, 4, 3), "NORMAL"), ((80, 4, 3), "WARNING"), ((60, 6, 3), "WARNING"), ((60, 4, 8), "WARNING"),
    ((92.5, 4, 3), "CRITICAL"), ((60, 4, 18), "CRITICAL"), ((60, 8.5, 3), "CRITICAL"),
    ((75, 5, 6), "NORMAL"), ((75.01, 4, 3), "WARNING"), ((90, 4, 3), "WARNING"), ((90.01, 4, 3), "CRITICAL"),
    ((60, 5.01, 3), "WARNING"), ((60, 7, 3), "WARNING"), ((60, 7.01, 3), "CRITICAL"),
    ((60, 4, 6.01), "WARNING"), ((60, 4, 15), "WARNING"), ((60, 4, 15.01), "CRITICAL"),
]


def test_severity_and_flags(spark):
    df = readings(spark, [{"temperature": float(t), "pressure": float(p), "vibration": float(v)}
                          for (t, p, v), _ in SEVERITY])
    out = enrich.enrich(df).orderBy("arrival_seq").collect()
    assert [r["anomaly_level"] for r in out] == [s for _, s in SEVERITY]
    for r, ((t, p, v), _) in zip(out, SEVERITY):
        assert r["temperature_alert"] == (t > 75) and r["pressure_alert"] == (p > 5) and r["vibration_alert"] == (v > 6)


def test_enrich_parses_iso_times(spark):
    df = readings(spark, [{"event_timestamp": "2026-09-13T18:30:00Z"},
                          {"event_timestamp": "2026-09-13T23:30:00-03:00"},
                          {"event_timestamp": "2026-09-13T18:30:00.250000+00:00"}])
    got = [str(r[0]) for r in enrich.enrich(df).orderBy("arrival_seq").selectExpr(
        "CAST(event_timestamp AS TIMESTAMP_NTZ)").collect()]
    assert got == ["2026-09-13 18:30:00", "2026-09-14 02:30:00", "2026-09-13 18:30:00.250000"]
