"""Physical-plan properties the design relies on (checked on the executed, AQE-final plans)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from vigil.plans import registry

QUERIES = registry.QUERIES
BATCH = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "archive_partition_counts", "reprocess_archive",
                                                         "dlq_scan_json"))]


def executed(spark, name) -> str:
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_and_latest_limit_before_the_shuffle(spark):
    plan = executed(spark, "current_status")
    assert "WindowGroupLimit" in plan and "Partial" in plan   # map-side: one row per key per partition leaves


def test_aggregates_are_partial(spark):
    plan = executed(spark, "anomaly_by_device")
    assert "partial_count" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = executed(spark, "topic_route")
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    cols = {c.split("#")[0] for c in scan.split("FileScan parquet [", 1)[1].split("]", 1)[0].split(",")}
    assert cols == {"event_id", "user_id"}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_evaluation(spark, name):
    plan = executed(spark, name)
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "RoundRobin" not in plan   # nothing depends on how small the input is


SERVED = ["critical_now", "top_temperature", "top_vibration", "total_events", "events_by_status", "events_by_anomaly",
          "avg_by_device", "alerts_by_device", "anomaly_by_device", "lookup_event", "lookup_device_time", "lookup_metrics",
          "refined_constraints", "sql_hot_days"]


@pytest.mark.parametrize("name", SERVED)
def test_serving_queries_read_the_stored_table_once(spark, name):
    plan = executed(spark, name).split("== Initial Plan ==")[0]
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(scans) == 1 and "refined-table" in scans[0]
    assert "events.parquet" not in plan


def test_lookups_reach_the_scan(spark):
    plan = executed(spark, "lookup_device_time")
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "EqualTo(device_id,MTR-0027)" in scan and "event_date" in scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


@pytest.mark.parametrize("name", ["moving_avg", "work_orders", "maintenance_reasons", "lifecycle_summary", "maintenance_state", "health_scores"])
def test_running_state_does_not_check_and_dedup_again(spark, name):
    assert "events.parquet" not in executed(spark, name)


def test_located_lookup_opens_one_day(spark, scratch):
    """A hundred days, a file each: an id opens one of them, and one bucket of the locator."""
    from vigil.plans import store
    days = spark.range(5000).selectExpr("concat('e', id) AS event_id", "date_add(DATE '2026-01-01', CAST(id % 100 AS INT)) AS event_date", "id AS n")
    days.coalesce(1).write.partitionBy("event_date").parquet(f"{scratch}/table")
    where = store.RunTable(f"{scratch}/locator", store.LOCATOR, "event_id", lambda rows: rows.distinct(), bucket_rows=100)
    where.add(days, 0)
    table = spark.read.parquet(f"{scratch}/table")
    assert len(table.inputFiles()) == 100
    found = store.find_events(table, where, ["e250", "e251", "none"])
    assert sorted((r.event_id, r.n) for r in found.collect()) == [("e250", 250), ("e251", 251)]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "event_date" in scan.split("PartitionFilters:")[1].split("]")[0]
    metrics = found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numFiles").value() == 2
    asked = spark.createDataFrame([("e250",)], "event_id string")
    paths = where.paths_of(spark, where.runs(spark), asked)
    assert [len(p) for p in paths.values()] == [1] and where.runs(spark)[0].buckets == 64
    assert store.find_events(table, where, ["none"]).count() == 0
