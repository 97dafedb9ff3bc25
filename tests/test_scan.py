"""The chunked prefix scan must equal a plain per-key window for any chunk size, including a key that holds a
third of all rows (the skew case it exists for)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import scan, windows


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "HOT" if i % 3 == 0 else f"K{rng.randrange(40)}"
        rows.append((i, key, rng.randrange(-50, 100) / 10.0))
    return spark.createDataFrame(rows, "seq long, k string, x double")


@pytest.mark.parametrize("span", [1, 7, 64, 1 << 22])
def test_running_equals_window(spark, skewed, span):
    aggs = {"s": ("sum", "CAST(x * 10 AS BIGINT)"), "lo": ("min", "x"), "hi": ("max", "x"),
            "n": ("sum", "CAST(1 AS BIGINT)")}
    got = scan.running(skewed, "k", "seq", aggs, span=span)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("seq", F.sum((F.col("x") * 10).cast("bigint")).over(w).alias("s"), F.min("x").over(w).alias("lo"),
                         F.max("x").over(w).alias("hi"), F.count(F.lit(1)).over(w).alias("n"))
    assert sorted(got.select("seq", "s", "lo", "hi", "n").collect()) == sorted(want.collect())


def test_exclusive_running_max(spark, skewed):
    got = scan.running(skewed, "k", "seq", {"m": ("max", "x")}, exclusive=True, span=16)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.select("seq", F.max("x").over(w).alias("m"))
    assert sorted(got.select("seq", "m").collect()) == sorted(want.collect())


def test_global_sequence(spark, skewed):
    got = scan.sequence(skewed, None, "seq", "n", span=100).select("seq", "n").collect()
    assert all(r["n"] == r["seq"] + 1 for r in got)


def test_moving_avg_blocks_equal_window(spark, skewed):
    got = windows.moving_avg(skewed, 5, "x", "k", "seq", block=8, span=32)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(-4, 0)
    want = skewed.select("k", "seq", (F.sum(F.col("x").cast("decimal(18,2)")).over(w).cast("double")
                                      / F.count("x").over(w).cast("double")).alias("moving_avg_x"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("span", [7, 1 << 22])
def test_rows_of_a_null_order_stay(spark, skewed, span):
    rows = skewed.union(spark.createDataFrame([(None, "HOT", 1.0), (None, "K1", 2.0), (None, "HOT", 3.0)], skewed.schema))
    got = scan.running(rows, "k", "seq", {"n": ("sum", "CAST(1 AS BIGINT)"), "hi": ("max", "x")}, span=span).collect()
    assert len(got) == 3003
    assert sorted((r.k, r.n) for r in got if r.seq is None) == [("HOT", 1), ("HOT", 2), ("K1", 1)]
    first = min((r for r in got if r.k == "HOT" and r.seq is not None), key=lambda r: r.seq)
    assert first.n == 3 and first.hi == max(3.0, first.x)
    assert sorted(r.n for r in scan.sequence(rows, None, "seq", "n", span=span).collect()) == list(range(1, 3004))


def test_moving_avg_range_of_a_hot_key(spark):
    """A key's readings of a few hours are cut by row count; null values, null keys, ties and both ends count."""
    df = spark.range(4000).selectExpr("IF(id % 10 = 3, NULL, IF(id % 3 = 0, 'K', 'HOT')) AS k", "id AS seq", "timestamp_seconds(1700000000 + (id * 37) % 3000 * 10) AS t",
                                      "IF(id % 11 = 0 OR id < 5, NULL, CAST(id % 70 AS DOUBLE) / 10) AS x").union(spark.sql("SELECT 'ALONE', 9000L, timestamp_seconds(5), CAST(NULL AS DOUBLE)"))
    w = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-600_000_000, 0)
    want = df.select("k", "seq", (F.sum(F.col("x").cast("decimal(18,2)")).over(w).cast("double") / F.count("x").over(w).cast("double")).alias("a"))
    got = windows.moving_avg_range(df, 10, "x", "k", "t", "seq")
    plain = lambda d: sorted(map(str, (tuple(r) for r in d.collect())))
    assert plain(got) == plain(want) and got.count() == 4001
    import glob
    import os
    newest = max(glob.glob(f"{scratch_root(spark)}/chunks-*"), key=os.path.getmtime)
    assert max(r["count"] for r in spark.read.parquet(newest).groupBy("_k", "_blk").count().collect()) < 2500


def test_rows_are_exchanged_once(spark, skewed):
    """Rows are exchanged by (key, chunk) once; the other exchanges carry partial totals and the chunk table."""
    df = scan.running(skewed, "k", "seq", {"n": ("sum", "CAST(1 AS BIGINT)")}, span=64)
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert sum("_v_n" in line or "Window" in line for line in text.split("\n")) >= 1 and 1 <= len(exchanges) <= 4


def test_sessions_equal_session_window(spark):
    from conftest import SF_SMALL
    from vigil.plans import refine
    ref = refine.refined(spark, SF_SMALL)
    assert sorted(windows.sessions(ref, "6 hours").collect()) == sorted(windows.sessions_stream(ref, "6 hours").collect())


def test_chunks_by_rows_split_a_hot_key(spark):
    """One device holds all readings of one day: chunks are as large as range partitions, and results are the same."""
    hot = spark.range(4000).selectExpr("'MTR-1' AS k", "id AS seq", "timestamp_seconds(1700000000 + id % 600) AS t", "CAST(id % 7 AS DOUBLE) AS x")
    got = scan.running(hot, "k", "t", {"n": ("sum", "CAST(1 AS BIGINT)"), "top": ("peak", "CAST(x - 3 AS BIGINT)")}, tiebreak="seq", by_rows=True)
    w = Window.partitionBy("k").orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("seq", F.count("*").over(w).alias("n"), F.sum((F.col("x") - 3).cast("long")).over(w).alias("s"))
    peak = want.select("seq", "n", F.max("s").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)).alias("top"))
    assert _same(got.select("seq", "n", "top"), peak)
    import glob
    import os
    newest = max(glob.glob(f"{scratch_root(spark)}/chunks-*"), key=os.path.getmtime)
    sizes = [r["count"] for r in spark.read.parquet(newest).groupBy("_blk").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500


def scratch_root(spark) -> str:
    from vigil.session import scratch_path
    return scratch_path(spark, "x").removeprefix("file:").rsplit("/", 1)[0]


def test_dead_letter_sequence_over_two_partitions(spark):
    """Offsets of two topic partitions tie; time, partition and offset order them."""
    from vigil.operators import consumers
    rows = [(p, o, 100 * o + p, f"e{p}-{o}", "d", "bad") for p in (0, 1) for o in range(50)]
    q = spark.createDataFrame(rows, "kafka_partition int, arrival_seq long, ms long, event_id string, device_id string, error_reason string")
    q = q.withColumn("kafka_timestamp", F.timestamp_millis("ms")).repartition(5)
    order = ["kafka_timestamp", "kafka_partition", "arrival_seq"]
    got = {r["event_id"]: r["quarantine_id"] for r in consumers.dlq_records(q, order).collect()}
    assert got == {e: f"dlq-{n}" for n, (*_, e, _, _) in enumerate(sorted(rows, key=lambda r: r[2]), 1)}
    alarm = consumers.dlq_alarms(q, 11, order).collect()
    assert [(r["event_id"], r["alarm_at"]) for r in alarm] == [("e0-5", 5)]


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_operators_chunked_equal_unchunked(spark):
    """Each operator built on the prefix scan gives the same rows with many chunks per device as with one."""
    from conftest import SF_SMALL
    from vigil.operators import consumers
    from vigil.plans import refine
    raw = refine.tel.telemetry(spark, SF_SMALL)
    ref = refine.refined(spark, SF_SMALL)
    small = 7   # arrival units per chunk: every device is cut into many chunks
    assert _same(consumers.running_metrics(raw, span=small), consumers.running_metrics(raw))
    st_small = consumers.maintenance_state(ref, span=small).drop("_acc")
    assert _same(st_small, consumers.maintenance_state(ref).drop("_acc"))
    assert _same(consumers.work_orders(consumers.maintenance_state(ref, span=small)).drop("created_at"),
                 consumers.work_orders(consumers.maintenance_state(ref)).drop("created_at"))
    late = ["arrival_seq", "device_id", "is_late"]   # leave out wall-clock columns (differ between runs)
    assert _same(windows.late_flag(ref, span=small).select(late), windows.late_flag(ref).select(late))
    assert _same(windows.moving_avg(ref, 10, block=16, span=small), windows.moving_avg(ref, 10))
    q = refine.quarantined(spark, SF_SMALL)
    assert _same(consumers.dlq_records(q, span=small).drop("processed_at"),
                 consumers.dlq_records(q).drop("processed_at"))
    assert _same(consumers.dlq_alarms(q, n=3, span=small), consumers.dlq_alarms(q, n=3))
