"""Dedup, envelope, consumers, latest-state merge: the source system's unit cases as data plus the extra edge cases."""

from __future__ import annotations

from conftest import readings
from pyspark.sql import functions as F

from vigil.operators import consumers, dedup, latest
from vigil.plans import refine
from vigil.sources import envelope


def test_dedup_keeps_first_in_arrival_order(spark):
    df = readings(spark, [{"event_id": i, "temperature": float(n)} for n, i in
                          enumerate(["001", "002", "001", "003"])])
    out = dedup.dedup_first(df).orderBy("arrival_seq").collect()
    assert [r["event_id"] for r in out] == ["001", "002", "003"]
    assert [r["temperature"] for r in out] == [0.0, 1.0, 3.0]


def test_first_valid_copy_wins(spark):
    # an invalid first copy must not hide a valid later copy of the same id
    df = readings(spark, [{"event_id": "a", "status": "EXPLODED"}, {"event_id": "a", "temperature": 70.0},
                          {"event_id": "a", "temperature": 71.0}])
    out = refine.refined_from(df).collect()
    assert len(out) == 1 and out[0]["temperature"] == 70.0


def test_envelope_check(spark):
    df = spark.createDataFrame([("not json",), ("[1, 2]",), ('{"device_id": "MTR-005"}',), ("{}",), ('"x"',),
                                ("",), (None,)], "value string")
    assert [r["accepted"] for r in envelope.valid_envelope(df).collect()] == [False, False, True, False, False,
                                                                               False, False]


def test_keyed_records_use_device_as_key(spark):
    df = readings(spark, [{"device_id": "MTR-005"}, {"device_id": ""}, {"device_id": None}])
    keys = [r["key"] for r in envelope.keyed_records(df).collect()]
    assert keys == ["MTR-005", None, None]


def test_parse_round_trip_keeps_raw_text(spark):
    df = readings(spark, [{"temperature": 95.5}], with_arrival=False)
    parsed = envelope.parse(envelope.to_payload(df, exclude=())).collect()[0]
    assert parsed["temperature"] == 95.5 and parsed["device_id"] == "MTR-001" and '"temperature":95.5' in parsed["value"]


def test_topic_route(spark):
    df = spark.createDataFrame([("industrial/machines/MTR-001/telemetry",), ("industrial/machines/a/b/telemetry",),
                                ("factory/MTR-001",)], "topic string")
    got = [(r["matched"], r["routed_device"]) for r in envelope.route(df).collect()]
    assert got == [(True, "MTR-001"), (False, None), (False, None)]


def test_alert_case(spark):
    df = readings(spark, [{"temperature": 96.5, "pressure": 4.5, "vibration": 5.0, "status": "RUNNING"},
                          {"temperature": 60.0, "pressure": 3.0, "vibration": 2.0}])
    df = df.withColumn("anomaly_level", F.when(F.col("arrival_seq") == 0, "CRITICAL").otherwise("NORMAL"))
    out = consumers.alerts(df).collect()
    assert len(out) == 1
    assert out[0]["severity"] == "CRITICAL"
    assert out[0]["reasons"] == ["Temperature CRITICAL (96.5°C > 90.0°C)"]
    assert out[0]["alert_id"].startswith("alt-") and len(out[0]["alert_id"]) == 68


def test_alert_flagged_only_and_failure(spark):
    df = readings(spark, [{"status": "failure"}]).withColumn("anomaly_level", F.lit(None).cast("string"))
    assert consumers.alerts(df).collect()[0]["reasons"] == ["Machine Status FAILURE"]
    df2 = readings(spark, [{}]).withColumn("anomaly_level", F.lit("critical"))
    assert consumers.alerts(df2).collect()[0]["reasons"] == ["Anomaly Level CRITICAL Flagged"]


def test_metrics_case(spark):
    df = readings(spark, [{"temperature": 80.0, "vibration": 5.0}, {"temperature": 100.0, "vibration": 15.0}])
    r = consumers.device_metrics(df).collect()[0]
    assert (r["total_events"], r["avg_temperature"], r["min_temperature"], r["max_temperature"], r["avg_vibration"]) \
        == (2, 90.0, 80.0, 100.0, 10.0)


def test_status_distribution_map(spark):
    df = readings(spark, [{"status": "RUNNING"}, {"status": "running"}, {"status": None}])
    m = consumers.status_distribution(df, nested=True).collect()[0]["status_distribution"]
    assert m == {"RUNNING": 2, "UNKNOWN": 1}


def test_archive_partition_is_utc_day(spark):
    df = readings(spark, [{"event_timestamp": "2026-09-13T18:30:00Z"}, {"event_timestamp": "2026-09-13T23:30:00-03:00"}])
    out = consumers.archive_records(df).orderBy("raw_payload.arrival_seq").collect()
    assert [(r["year"], r["month"], r["day"]) for r in out] == [("2026", "09", "13"), ("2026", "09", "14")]


def test_dlq_counts(spark):
    q = spark.createDataFrame([(0, "e0", "MTR-001", "temperature_out_of_range"), (1, "e1", "", None)],
                              "arrival_seq long, event_id string, device_id string, error_reason string")
    assert consumers.dlq_summary(q).collect()[0]["total_quarantined_events"] == 2
    assert {r["device_id"] for r in consumers.dlq_by_device(q).collect()} == {"MTR-001", "UNKNOWN_DEVICE"}
    assert [r["quarantine_id"] for r in consumers.dlq_records(q).orderBy("arrival_seq").collect()] == ["dlq-1", "dlq-2"]


def test_maintenance_case(spark):
    df = readings(spark, [{"vibration": 12.0, "temperature": 60.0}])
    lim = consumers.WearLimits(max_accumulated_vibration=10.0)
    state = consumers.maintenance_state(df, lim)
    wo = consumers.work_orders(state).collect()
    assert len(wo) == 1 and wo[0]["priority"] == "MEDIUM" and wo[0]["health_score"] == 50.0
    assert wo[0]["reasons"] == ["Excessive Accumulated Vibration (12.0 >= 10.0)"]
    assert wo[0]["work_order_id"] == "WO-MTR-001-1"


def test_work_order_latched_once(spark):
    df = readings(spark, [{"status": "FAILURE"}, {"status": "FAILURE"}, {"vibration": 200.0}])
    wo = consumers.work_orders(consumers.maintenance_state(df)).collect()
    assert len(wo) == 1 and wo[0]["trigger_event_id"] == "evt-0" and wo[0]["priority"] == "HIGH"
    life = consumers.lifecycle_by_device(df).collect()[0]
    assert life["maintenance_required"] and life["maintenance_reasons"] == ["Catastrophic Machine Failure Detected"]


def test_merge_late_batch_does_not_roll_back(spark):
    new = readings(spark, [{"event_timestamp": "2026-09-13T18:30:00Z", "temperature": 61.0}])
    late = readings(spark, [{"event_timestamp": "2026-09-13T10:00:00Z", "temperature": 99.0}])
    from vigil.operators import enrich
    snap = latest.merge_snapshot(None, enrich.enrich(new))
    snap2 = latest.merge_snapshot(snap, enrich.enrich(late).withColumn("arrival_seq", F.lit(5).cast("long")))
    assert snap2.collect()[0]["temperature"] == 61.0


def test_kafka_records_to_readings(spark):
    """Topic-shaped rows (as the Kafka source yields them) -> parsed readings ordered by partition offset."""
    from vigil.sources import streams
    raw = spark.createDataFrame(
        [(b"MTR-001", b'{"event_id": "e1", "device_id": "MTR-001", "temperature": 95.5}', 3, 41, "iot-machine-events"),
         (b"MTR-001", b'{"event_id": "e1", "device_id": "MTR-001", "temperature": 95.5}', 3, 42, "iot-machine-events")],
        "key binary, value binary, partition int, offset long, topic string"
    ).withColumn("timestamp", F.current_timestamp())
    r = streams.kafka_readings(raw).orderBy("arrival_seq").collect()
    assert [x["arrival_seq"] for x in r] == [41, 42] and r[0]["temperature"] == 95.5
    assert r[0]["value"].startswith('{"event_id": "e1"') and r[0]["kafka_partition"] == 3
    assert dedup.dedup_first(streams.kafka_readings(raw)).collect()[0]["arrival_seq"] == 41


def test_constraint_violations_are_counted(spark):
    from vigil.operators import quality
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 2), ("b", None), (None, 3), (None, None)], "k string, v int")
    r = quality.constraint_violations(df, "k", ["k", "v"]).first().asDict()
    assert r == {"duplicate_keys": 2, "null_k": 2, "null_v": 3}
    assert quality.constraint_violations(df.where("false"), "k", ["v"]).first().asDict() == {"duplicate_keys": 0, "null_v": 0}


def test_alert_ids_without_an_event_id_differ(spark):
    rows = readings(spark, [{"event_id": None, "device_id": f"d{i % 2}", "temperature": 95.0} for i in range(6)])
    assert consumers.alerts(rows).select("alert_id").distinct().count() == 6


def test_metrics_snapshot_equals_the_parts(spark):
    rows = readings(spark, [{"device_id": f"d{i % 3}", "status": "RUNNING" if i % 2 else "STOPPED", "temperature": float(i)} for i in range(30)])
    snap = consumers.metrics_snapshot(consumers.metrics_by_status(rows))
    want = {r["device_id"]: r for r in consumers.device_metrics(rows).collect()}
    by_status = {(r["device_id"], r["status"]): r["n"] for r in consumers.status_distribution(rows).collect()}
    for r in snap.collect():
        assert all(r[c] == want[r["device_id"]][c] for c in snap.columns if c != "status_distribution")
        assert r["status_distribution"] == {s: n for (d, s), n in by_status.items() if d == r["device_id"]}
    assert consumers.fleet_of(snap).select("total_processed_events", "total_active_devices").first() == (30, 3)
