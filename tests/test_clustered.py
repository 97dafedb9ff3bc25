"""The clustered table: the same rows, files of bounded size also for a hot device, reads that open the files whose zones fit."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from conftest import SF_CHECK, readings

from vigil.plans import clustered, refine, store

UTC = dt.timezone.utc


@pytest.fixture(scope="module")
def table(spark):
    from vigil.session import scratch_path
    path = scratch_path(spark, "clustered")
    source = store.refined_table(spark, SF_CHECK)
    clustered.write_clustered(source, path, file_rows=-(-source.count() // 100))
    return source, path


def _ids(df):
    return Counter(r.event_id for r in df.select("event_id").collect())


def test_interleaved_bits(spark):
    got = spark.sql("SELECT 5 AS a, 3 AS b UNION ALL SELECT 63, 0 UNION ALL SELECT 0, 63").select("a", clustered.interleaved("a", "b").alias("z")).collect()
    assert {r.a: r.z for r in got} == {5: 0b011011, 63: 0b010101010101, 0: 0b101010101010}


def test_same_rows_and_zones_of_all_files(spark, table):
    source, path = table
    assert _ids(store.read_refined(spark, path)) == _ids(source)
    zones = clustered.read_zones(spark, path).collect()
    assert len(zones) >= 100 and sum(z.records for z in zones) == source.count()
    assert sorted(z.file.split("/")[-1] for z in zones) == sorted(f.split("/")[-1] for f in store.read_refined(spark, path).inputFiles())


def test_a_device_at_a_time_opens_one_or_two_files(spark, table):
    source, path = table
    for r in source.select("event_id", "device_id", "event_timestamp").orderBy("event_id").limit(5).collect():
        at = r.event_timestamp.replace(tzinfo=UTC)
        found = clustered.find(spark, path, r.device_id, at, at)
        assert r.event_id in _ids(found) and 1 <= len(found.inputFiles()) <= 2


def test_reads_equal_filters_of_the_source(spark, table):
    source, path = table
    device = source.groupBy("device_id").count().orderBy("count", ascending=False).first().device_id
    since, until = dt.datetime(2024, 1, 3, 5, tzinfo=UTC), dt.datetime(2024, 1, 9, 7, 30, tzinfo=UTC)
    span = "event_timestamp BETWEEN TIMESTAMP '2024-01-03 05:00:00Z' AND TIMESTAMP '2024-01-09 07:30:00Z'"
    for found, where in ((clustered.find(spark, path, device), f"device_id = '{device}'"), (clustered.find(spark, path, since=since, until=until), span),
                         (clustered.find(spark, path, device, since, until, "CRITICAL"), f"device_id = '{device}' AND anomaly_level = 'CRITICAL' AND {span}"),
                         (clustered.find(spark, path, level="WARNING"), "anomaly_level = 'WARNING'"), (clustered.find(spark, path), "true"),
                         (clustered.find(spark, path, "no such device"), "false")):
        assert _ids(found) == _ids(source.where(where))


def test_a_read_of_more_files_than_are_named_is_whole(spark, table, monkeypatch):
    source, path = table
    monkeypatch.setattr(clustered, "NAMED", 3)
    assert _ids(clustered.find(spark, path, level="NORMAL")) == _ids(source.where("anomaly_level = 'NORMAL'"))


def test_a_hot_device_is_split_and_an_empty_table_is_read(spark, scratch):
    rows = [{"event_id": f"e{i}", "device_id": "HOT" if i % 3 else f"D{i % 50:02d}", "event_timestamp": f"2026-03-01T{i % 24:02d}:{i % 60:02d}:00Z"} for i in range(1500)]
    refined = refine.refined_from(readings(spark, rows))
    refined.write.parquet(f"{scratch}/source")
    refined = spark.read.parquet(f"{scratch}/source")
    clustered.write_clustered(refined, f"{scratch}/table", file_rows=100)
    sizes = [z.records for z in clustered.read_zones(spark, f"{scratch}/table").collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 400
    assert clustered.find(spark, f"{scratch}/table", "HOT").count() == 1000
    clustered.write_clustered(refined.limit(0), f"{scratch}/none")
    assert clustered.find(spark, f"{scratch}/none", "HOT").count() == 0
