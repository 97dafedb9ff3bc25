"""Streaming end state = batch result, for a replay split into several micro-batches; restart from checkpoint;
cross-batch duplicates; late rows dropped by the watermark."""

from __future__ import annotations

import os
import time

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL

from vigil.operators import consumers, latest
from vigil.plans import refine
from vigil.sources import streams
from vigil.streaming import consumers as cstream
from vigil.streaming import medallion

# split points chosen so that duplicate ids (n, n+1 with n+1 = 39 mod 40) straddle micro-batches
SPLITS = [0, 39, 279, 599, 10 ** 9]
REFINED_COLS = ["arrival_seq", "event_id", "device_id", "event_timestamp", "temperature", "pressure", "vibration",
                "rpm", "machine_status", "anomaly_level", "temperature_alert", "pressure_alert", "vibration_alert"]


def write_parts(folder: str, parts=range(len(SPLITS) - 1)) -> None:
    """Parts of the events table by event_id range, with ascending modification times (replay order)."""
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    table = pq.read_table(f"{SF_SMALL}/events.parquet")
    ids = table.column("event_id").to_pylist()
    now = time.time() - 1000
    for p in parts:
        lo, hi = SPLITS[p], SPLITS[p + 1]
        mask = [lo <= i < hi for i in ids]
        path = f"{folder}/part-{p:03d}.parquet"
        pq.write_table(table.filter(mask), path)
        os.utime(path, (now + p, now + p))


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture
def parts(scratch):
    folder = f"{scratch}/events"
    write_parts(folder)
    return folder


def test_refined_stream_equals_batch(spark, parts, scratch):
    writer = medallion.RefinedWriter(f"{scratch}/out")
    q = medallion.start_refined(streams.telemetry_replay(spark, parts), writer, f"{scratch}/ck")
    q.awaitTermination()
    assert len(q.recentProgress) == 4
    c = writer.last_counts                       # per-batch counts observed without extra jobs
    assert c["batch_id"] == 3 and c["raw_count"] == c["valid_count"] + c["invalid_count"] == 1000 - 599
    got = spark.read.parquet(writer.refined_path)
    want = refine.refined(spark, SF_SMALL)
    assert rows(got, REFINED_COLS) == rows(want, REFINED_COLS)
    status = medallion.read_current_status(spark, writer.status_path)
    cols = ["device_id", "last_event_id", "last_event_timestamp", "temperature", "machine_status"]
    assert rows(status, cols) == rows(latest.current_status(want), cols)
    # every reading lands in exactly one of quarantine / valid (valid = refined + dropped duplicates)
    q_rows = spark.read.parquet(writer.quarantine_path).count()
    assert q_rows == refine.quarantined(spark, SF_SMALL).count() == 1000 - 913


def test_restart_from_checkpoint(spark, scratch):
    folder = f"{scratch}/events"
    write_parts(folder, parts=[0, 1])
    writer = medallion.RefinedWriter(f"{scratch}/out")
    medallion.start_refined(streams.telemetry_replay(spark, folder), writer, f"{scratch}/ck").awaitTermination()
    write_parts(folder, parts=[2, 3])           # new input arrives while the query is down
    writer2 = medallion.RefinedWriter(f"{scratch}/out")
    q = medallion.start_refined(streams.telemetry_replay(spark, folder), writer2, f"{scratch}/ck")
    q.awaitTermination()
    assert len(q.recentProgress) == 2           # only the new files were processed after the restart
    got = spark.read.parquet(writer2.refined_path)
    assert rows(got, REFINED_COLS) == rows(refine.refined(spark, SF_SMALL), REFINED_COLS)


def reading(i, **other):
    return {"arrival_seq": i, "event_id": f"evt-{i}", **other}


def test_batches_without_publishable_rows(spark, scratch):
    """All invalid, then valid, then the same again: nothing fails, nothing is published twice, and the writer works
    on after a restart."""
    from conftest import readings
    bad = readings(spark, [reading(i, status="EXPLODED") for i in range(3)])
    good = readings(spark, [reading(i) for i in range(3, 6)])
    maint = cstream.MaintenanceWriter(f"{scratch}/m")
    for batch_id, batch in enumerate([bad, good, good, bad]):
        writer = medallion.RefinedWriter(f"{scratch}/out", downstream=[maint])   # a restart before every batch
        writer(batch, batch_id)
        assert writer.last_counts["batch_id"] == batch_id
    assert spark.read.parquet(writer.refined_path).count() == 3
    assert spark.read.parquet(writer.quarantine_path).count() == 6
    assert medallion.read_current_status(spark, writer.status_path).count() == 1
    assert [r.total_cycles for r in cstream.read_snapshot(spark, f"{scratch}/m/snapshot").collect()] == [3]


def test_another_query_cannot_replace_batches(spark, parts, scratch):
    writer = medallion.RefinedWriter(f"{scratch}/out")
    medallion.start_refined(streams.telemetry_replay(spark, parts), writer, f"{scratch}/ck").awaitTermination()
    q = medallion.start_refined(streams.telemetry_replay(spark, parts), writer, f"{scratch}/another")
    with pytest.raises(Exception, match="holds batches of query"):
        q.awaitTermination()


def test_maintenance_snapshots_are_pruned_and_latched_on_raw_readings(spark, scratch):
    from conftest import readings
    maint = cstream.MaintenanceWriter(f"{scratch}/m", keep=2)
    for b, vibration in enumerate([101.0, -50.0, -50.0, 1.0]):
        maint(readings(spark, [reading(b, vibration=vibration)]), b)
    state = spark.read.parquet(f"{scratch}/m/state_rows").orderBy("arrival_seq").collect()
    assert [r.maintenance_required for r in state] == [True] * 4
    assert [r.accumulated_vibration for r in state] == [101.0, 51.0, 1.0, 2.0]
    assert len([x for x in os.listdir(f"{scratch.removeprefix('file:')}/m/snapshot") if x.startswith("v=")]) == 2


def test_archive_keeps_the_message_whole(spark, scratch):
    from vigil.sources import envelope
    texts = ["not json", '{"event_id": "e1", "unknown": [1, 2], "event_timestamp": "2026-09-13T18:30:00Z"}']
    raw = spark.createDataFrame(list(enumerate(texts)), "arrival_seq long, value string")
    got = consumers.archive_records(envelope.parse(raw)).collect()
    assert [r.raw_text for r in got] == texts and {(r.year, r.month, r.day) for r in got[1:]} == {("2026", "09", "13")}


def test_quarantine_can_be_taken_in_again(spark):
    from conftest import readings
    from vigil.functions import rules
    from vigil.operators import quality
    from vigil.plans import stream_runs
    import dataclasses
    raw = readings(spark, [reading(0), reading(1, temperature=250.0), reading(2, status="EXPLODED")])
    _, invalid = quality.split(quality.check(raw))
    wider = dataclasses.replace(rules.LIMITS, temperature_max=300.0)
    again = stream_runs.reprocess_quarantine(spark, quality.quarantine(invalid), wider)
    assert [r.event_id for r in again.collect()] == ["evt-1"]


def test_replayed_batch_is_idempotent(spark, parts, scratch):
    writer = medallion.RefinedWriter(f"{scratch}/out")
    batch = refine.tel.telemetry(spark, SF_SMALL)
    writer(batch, 0)
    writer(batch, 0)                            # the same micro-batch delivered twice
    assert spark.read.parquet(writer.refined_path).count() == refine.refined(spark, SF_SMALL).count()


def test_maintenance_stream_equals_batch(spark, parts, scratch):
    maint = cstream.MaintenanceWriter(f"{scratch}/m")
    writer = medallion.RefinedWriter(f"{scratch}/out", downstream=[maint])
    medallion.start_refined(streams.telemetry_replay(spark, parts), writer, f"{scratch}/ck").awaitTermination()
    got = consumers.snapshot_view(cstream.read_snapshot(spark, f"{scratch}/m/snapshot"))
    want = consumers.lifecycle_by_device(refine.refined(spark, SF_SMALL))
    cols = ["device_id", "total_cycles", "running_cycles", "accumulated_vibration", "high_temp_cycles",
            "high_pressure_cycles", "last_status", "maintenance_required", "health_score"]
    assert rows(got, cols) == rows(want, cols)
    assert rows(got.selectExpr("device_id", "concat_ws(';', maintenance_reasons) r"), ["device_id", "r"]) == \
        rows(want.selectExpr("device_id", "concat_ws(';', maintenance_reasons) r"), ["device_id", "r"])
    orders = spark.read.parquet(f"{scratch}/m/work_orders")
    assert orders.count() == orders.select("device_id").distinct().count()   # at most one order per device
    batch_orders = consumers.work_orders(consumers.maintenance_state(refine.refined(spark, SF_SMALL)))
    ocols = ["work_order_id", "device_id", "trigger_event_id", "priority", "health_score"]
    assert rows(orders, ocols) == rows(batch_orders, ocols)


def test_metrics_stream_equals_batch(spark, parts, scratch):
    cstream.start_metrics(streams.telemetry_replay(spark, parts), f"{scratch}/m", f"{scratch}/ck").awaitTermination()
    got = cstream.read_snapshot(spark, f"{scratch}/m")
    want = consumers.device_metrics(refine.tel.telemetry(spark, SF_SMALL))
    cols = ["device_id", "total_events", "avg_temperature", "max_vibration", "last_event_timestamp"]
    assert rows(got, cols) == rows(want, cols)


def test_stream_dedup_across_batches(spark, parts, scratch):
    medallion.start_stream_dedup(streams.telemetry_replay(spark, parts), f"{scratch}/d", f"{scratch}/ck",
                                 delay="1 day").awaitTermination()
    out = spark.read.parquet(f"{scratch}/d")
    assert out.count() == out.select("event_id").distinct().count() == refine.refined(spark, SF_SMALL).count()


def test_stream_dedup_loses_nothing_in_small_pieces(spark, scratch):
    """At the default: 40 pieces of 25 readings, hours-late ones among them, publish each valid id once."""
    folder = f"{scratch.removeprefix('file:')}/events"
    os.makedirs(folder)
    table, now = pq.read_table(f"{SF_SMALL}/events.parquet"), time.time() - 1000
    for p in range(40):
        pq.write_table(table.slice(25 * p, 25), f"{folder}/part-{p:03d}.parquet")
        os.utime(f"{folder}/part-{p:03d}.parquet", (now + p, now + p))
    medallion.start_stream_dedup(streams.telemetry_replay(spark, folder, 2), f"{scratch}/d", f"{scratch}/ck").awaitTermination()
    got = spark.read.parquet(f"{scratch}/d").select("event_id")
    assert rows(got, ["event_id"]) == rows(refine.refined(spark, SF_SMALL), ["event_id"])


def test_late_rows_dropped_by_watermark(spark, parts, scratch):
    """A fifth micro-batch re-delivers the first part's readings (days older than the watermark). The stream must
    drop them: every closed window holds exactly the batch count of the original data, none counted twice."""
    import shutil
    late = f"{parts}/part-999.parquet".removeprefix("file:")
    shutil.copyfile(f"{parts}/part-000.parquet".removeprefix("file:"), late)
    os.utime(late, (time.time(), time.time()))
    q = cstream.start_late_demo(streams.telemetry_replay(spark, parts), f"{scratch}/late", f"{scratch}/ck")
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1000 + 39
    emitted = spark.read.parquet(f"{scratch}/late")
    batch = cstream.late_window_counts(refine.tel.telemetry(spark, SF_SMALL), "10 minutes")
    keys = ["window_start", "device_id"]
    both = batch.join(emitted.select(*keys, emitted["n"].alias("streamed")), keys)
    assert both.filter("streamed <> n").count() == 0
    assert both.count() == emitted.count() >= batch.count() - 1     # only the last open window may be missing


def test_consumer_fan_out(spark, parts, scratch):
    """All consumers started by name on one session, each with its own checkpoint, over the same replay."""
    writer = medallion.RefinedWriter(f"{scratch}/out")
    medallion.start_refined(streams.telemetry_replay(spark, parts), writer, f"{scratch}/ck").awaitTermination()
    ref = spark.read.parquet(writer.refined_path)
    ref_stream = spark.readStream.schema(ref.schema).parquet(writer.refined_path)
    qs = cstream.start_consumers(spark, streams.telemetry_replay(spark, parts), f"{scratch}/c",
                                 refined_stream=ref_stream)
    assert set(qs) == set(cstream.NAMES)
    for q in qs.values():
        q.awaitTermination()
        assert q.exception() is None
    raw = refine.tel.telemetry(spark, SF_SMALL)
    assert spark.read.json(f"{scratch}/c/alerts").count() == consumers.alerts(raw).count()
    assert cstream.read_archive(spark, f"{scratch}/c/archive").count() == 1000
    assert cstream.read_snapshot(spark, f"{scratch}/c/metrics").count() == consumers.device_metrics(raw).count()
    snap = cstream.read_snapshot(spark, f"{scratch}/c/maintenance/snapshot")
    assert snap.count() == ref.select("device_id").distinct().count()


def test_quarantine_keeps_payload_as_received(spark, scratch):
    """Malformed or invalid messages from the topic are quarantined with their original text."""
    from vigil.sources import envelope
    raw = spark.createDataFrame(
        [(0, "not json at all"), (1, '{"event_id": "e1", "device_id": "MTR-001", "event_timestamp": "2026-09-13T18:30:00Z",'
          ' "temperature": 60.0, "pressure": 4.0, "vibration": 3.0, "rpm": 1500, "status": "RUNNING"}'),
         (2, '{"event_id": "e2", "device_id": "MTR-001", "status": "EXPLODED"}')], "arrival_seq long, value string")
    writer = medallion.RefinedWriter(f"{scratch}/out")
    writer(envelope.parse(raw), 0)
    q = {r["arrival_seq"]: r for r in spark.read.parquet(writer.quarantine_path).collect()}
    assert set(q) == {0, 2}
    assert q[0]["original_payload"] == "not json at all" and q[0]["event_id"] is None
    assert q[2]["original_payload"].startswith('{"event_id": "e2"')
    assert [r["event_id"] for r in spark.read.parquet(writer.refined_path).collect()] == ["e1"]


@pytest.mark.parametrize("seed", [11, 23])
def test_random_splits_equal_batch(spark, scratch, seed):
    """Stream end state equals the batch result for a random split of the input into micro-batches."""
    import random
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, 1000), 4))
    bounds = [0] + cuts + [10 ** 9]
    folder = f"{scratch}/events"
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    table = pq.read_table(f"{SF_SMALL}/events.parquet")
    ids = table.column("event_id").to_pylist()
    now = time.time() - 1000
    for p in range(len(bounds) - 1):
        path = f"{folder}/part-{p:03d}.parquet"
        pq.write_table(table.filter([bounds[p] <= i < bounds[p + 1] for i in ids]), path)
        os.utime(path, (now + p, now + p))
    maint = cstream.MaintenanceWriter(f"{scratch}/m")
    writer = medallion.RefinedWriter(f"{scratch}/out", downstream=[maint])
    medallion.start_refined(streams.telemetry_replay(spark, folder), writer, f"{scratch}/ck").awaitTermination()
    want = refine.refined(spark, SF_SMALL)
    assert rows(spark.read.parquet(writer.refined_path), REFINED_COLS) == rows(want, REFINED_COLS)
    cols = ["device_id", "last_event_id", "last_event_timestamp"]
    assert rows(medallion.read_current_status(spark, writer.status_path), cols) == \
        rows(latest.current_status(want), cols)
    got = consumers.snapshot_view(cstream.read_snapshot(spark, f"{scratch}/m/snapshot"))
    mcols = ["device_id", "total_cycles", "accumulated_vibration", "last_status", "maintenance_required",
             "health_score"]
    assert rows(got, mcols) == rows(consumers.lifecycle_by_device(want), mcols)


@pytest.mark.parametrize("operator", ["tumbling", "sliding", "sessions"])
def test_event_time_windows_on_a_stream_equal_batch(spark, parts, scratch, operator):
    from vigil.operators import windows
    from vigil.sources import schemas

    ref = refine.refined(spark, SF_SMALL)
    ref.repartition(3).write.parquet(f"{scratch}/refined")
    stream = spark.readStream.schema(schemas.REFINED).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/refined")
    apply = {"tumbling": windows.tumbling, "sliding": windows.sliding, "sessions": windows.sessions_stream}[operator]
    out = apply(stream).writeStream.outputMode("complete").option("checkpointLocation", f"{scratch}/ck")
    out.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{scratch}/out")).trigger(availableNow=True).start().awaitTermination()
    want = apply(ref)
    assert rows(spark.read.parquet(f"{scratch}/out"), want.columns) == rows(want, want.columns)
