"""Late readings set aside: with those kept they are the input, and they are what the windowed aggregate loses."""

from __future__ import annotations

from collections import Counter

from conftest import SF_SMALL, readings

from vigil.plans import stream_runs
from vigil.sources import telemetry as tel
from vigil.streaming import late


def test_kept_and_late_are_the_input_and_windows_of_kept_are_those_counted(spark):
    log = late.ProgressLog()
    spark.streams.addListener(log)
    try:
        counted = {(r.window_start, r.device_id): r.n for r in stream_runs.late_drop(spark, SF_SMALL).collect()}
        router = stream_runs.late_rows(spark, SF_SMALL)
        kept, gone = (router.read(spark, n) for n in ("kept", "late"))
        t = tel.telemetry(spark, SF_SMALL)
        assert sorted(r.arrival_seq for r in kept.select("arrival_seq").union(gone.select("arrival_seq")).collect()) == sorted(r.arrival_seq for r in t.select("arrival_seq").collect())
        own = kept.selectExpr("window(try_to_timestamp(event_timestamp), '1 hour').start AS s", "device_id").where("s IS NOT NULL").collect()
        own = Counter((r.s, r.device_id) for r in own)
        assert gone.count() > 0 and all(own[k] == n for k, n in counted.items()) and set(counted) <= set(own)
    finally:
        spark.streams.removeListener(log)
    rows = log.table(spark).collect()
    assert sum(r.input_rows for r in rows) == 2 * t.count() and sum(r.dropped_rows for r in rows) > 0
    assert sum(r.dropped_rows for r in rows) <= gone.count()  # Spark counts them after grouping by window and device


def test_a_replayed_batch_decides_as_before(spark, scratch):
    router = late.LateRouter(scratch)
    times = [["2026-01-01T10:00:00Z", None, "x"], ["2026-01-01T13:00:00Z", "2026-01-01T09:10:00Z"], ["2026-01-01T10:59:00Z", "2026-01-01T12:10:00Z", "2026-01-01T20:00:00Z"]]
    batches = [readings(spark, [{"event_timestamp": x, "arrival_seq": 10 * i + j} for j, x in enumerate(ts)]) for i, ts in enumerate(times)]
    for i in (0, 1, 1, 2, 2):
        router(batches[i], i)
    # 09:10 was not behind 09:50 (its window ends at 10:00); 10:59's window had ended by 12:50, 12:10's had not
    assert [(r.arrival_seq, str(r.watermark)) for r in router.read(spark, "late").collect()] == [(20, "2026-01-01 12:50:00")]
    assert sorted(r.arrival_seq for r in router.read(spark, "kept").collect()) == [0, 1, 2, 10, 11, 21, 22]
    router(batches[0].limit(0), 3)
    assert router.read(spark, "kept").count() == 7
