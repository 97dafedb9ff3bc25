"""Distinct counts from day sketches: exact where small, within the bound where large, and nothing but sketches is read."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from vigil.operators import sketches
from vigil.plans import registry, store


def test_unions_are_within_the_bound(spark):
    df = spark.range(60_000).select(F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("event_date"), F.expr("concat('d', id % 40000)").alias("device_id"))
    df = df.union(spark.sql("SELECT DATE '2024-01-02', CAST(NULL AS STRING)"))
    days = sketches.day_sketches(df, lg_k=12)
    exact = {r.event_date: (r.events, r.devices) for r in sketches.exact_devices(df).collect()}
    one = {r.event_date: (r.events, r.devices) for r in sketches.devices(days).collect()}
    assert one.keys() == exact.keys()
    for d, (n, k) in exact.items():
        assert one[d][0] == n and abs(one[d][1] - k) <= 4 * 1.04 / 64 * k
    week = max(sketches.devices(days, 7).collect())
    assert week.events == 60_001 and abs(week.devices - 40_000) <= 4 * 1.04 / 64 * 40_000


def test_small_counts_are_exact_and_late_readings_are_added(spark):
    one = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-09", "a")], "d string, device_id string").selectExpr("CAST(d AS DATE) AS event_date", "device_id")
    late = spark.createDataFrame([("2024-01-01", "b"), ("2024-01-01", "c")], "d string, device_id string").selectExpr("CAST(d AS DATE) AS event_date", "device_id")
    days = sketches.day_sketches(one).union(sketches.day_sketches(late))
    assert [(str(r.event_date), r.events, r.devices) for r in sorted(sketches.devices(days, 7).collect())] == [("2024-01-01", 4, 3), ("2024-01-09", 1, 1)]
    assert sketches.devices(sketches.day_sketches(one.limit(0))).collect() == []


def test_query_reads_sketches_only(spark):
    q = registry.QUERIES["fleet_devices_by_day"](spark, SF_SMALL)
    assert all("sketch-table" in f for f in q.inputFiles())
    exact = {r.event_date: (r.events, r.devices) for r in sketches.exact_devices(store.refined_table(spark, SF_SMALL)).collect()}
    assert {r.event_date: (r.events, r.devices) for r in q.collect()} == exact


def test_dead_letter_scans_read_the_stored_table(spark):
    for name in ("dlq_records", "dlq_alarms"):
        assert all("quarantine-table" in f for f in registry.QUERIES[name](spark, SF_SMALL).inputFiles())
