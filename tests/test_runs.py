"""Run tables, and the streaming operators that keep their state in them or in the state store: any cut of the readings
gives the batch result, a replayed batch changes nothing, a batch reads and writes what follows the batch."""

from __future__ import annotations

import glob
import os
import random
import shutil
import subprocess
import sys
import time

import pandas as pd
import pytest
from conftest import SF_SMALL, readings
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.operators import consumers, latest, quality, windows
from vigil.plans import refine
from vigil.sources import fs
from vigil.sources import telemetry as tel
from vigil.streaming import carried, medallion, wear
from vigil.streaming.runs import RunTable, id_index

COUNTS = StructType().add("k", "string").add("n", "long")


def sums(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def counts(spark, rows):
    return spark.createDataFrame(list(rows.items()), COUNTS)


def as_dict(df):
    return {r.k: r.n for r in df.collect()}


def ids(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("evt-"), "id").alias("event_id"))


# --- run tables

def test_runs_add_up_and_merge(spark, scratch):
    table, want = RunTable(scratch, COUNTS, "k", sums, bucket_rows=4, fanout=3), {}
    rng = random.Random(1)
    for batch in range(14):
        new = {f"k{rng.randrange(40)}": rng.randrange(9) for _ in range(rng.randrange(12))}
        table.add(counts(spark, new), batch)
        for k, n in new.items():
            want[k] = want.get(k, 0) + n
        assert as_dict(table.read(spark)) == want
        some = {k: want[k] for k in list(want)[:3]}
        part = as_dict(table.read(spark, keys=counts(spark, some)))
        assert some.items() <= part.items() and part.keys() <= want.keys()
    assert len(table.runs(spark)) <= 7 and table.read(spark, before=0).count() == 0


def test_a_replayed_batch_replaces_itself(spark, scratch):
    table = RunTable(scratch, COUNTS, "k", sums, fanout=2)
    for batch in range(5):
        table.add(counts(spark, {"a": 1, f"b{batch}": 1}), batch)
    table.add(counts(spark, {"a": 100}), 4)
    table.add(counts(spark, {"a": 1, "z": 5}), 4)
    assert as_dict(table.read(spark)) == {"a": 5, "z": 5, **{f"b{i}": 1 for i in range(4)}}
    assert as_dict(table.read(spark, before=4)) == {"a": 4, **{f"b{i}": 1 for i in range(4)}}
    table.add(counts(spark, {}), 4)
    assert as_dict(table.read(spark))["a"] == 4


def test_readers_of_an_older_state_find_its_files(spark, scratch):
    table = RunTable(scratch, COUNTS, "k", sums, fanout=2, keep=3)
    table.add(counts(spark, {"a": 1}), 0)
    old = table.read(spark)
    for batch in (1, 2):
        table.add(counts(spark, {"a": 1}), batch)
    assert as_dict(old) == {"a": 1} and as_dict(table.read(spark)) == {"a": 3}
    for batch in range(3, 12):
        table.add(counts(spark, {"a": 1}), batch)
    folders = {os.path.basename(p) for p in glob.glob(f"{scratch}/run-*")}
    listed = {r.name for s in table._states(spark) for r in table.runs(spark, state=s)}
    assert folders == listed and len(table._states(spark)) == 3


def test_a_second_writer_of_the_same_state_fails(spark, scratch):
    fs.publish_text(spark, f"{scratch}/x.json", "é")
    assert fs.read_text(spark, f"{scratch}/x.json") == "é"
    with pytest.raises(FileExistsError):
        fs.publish_text(spark, f"{scratch}/x.json", "2")
    assert fs.read_text(spark, f"{scratch}/x.json") == "é"


def test_bytes_read_follow_the_batch_not_the_history(spark, scratch):
    """Eight times the history: a read by the same few ids opens a bucket per id and run, of the same size, and runs grow
    with the logarithm."""
    index = id_index(scratch, bucket_rows=500)
    few = ids(spark, 5, 8).union(ids(spark, 10 ** 7, 10 ** 7 + 3))
    read, whole, batch, n = [], [], 0, 0
    for history in (5_000, 40_000):
        while n < history:
            index.add(ids(spark, n, n + 2_500), batch)
            n, batch = n + 2_500, batch + 1
        runs = index.runs(spark)
        paths = index.paths_of(spark, runs, few)
        assert all(len(p) <= 6 for p in paths.values())
        read.append(sum(fs.size(spark, p) for ps in paths.values() for p in ps) / len(runs))
        assert len(runs) <= 4 * (1 + len(bin(history // 2_500)) / 2)
        whole.append(fs.size(spark, scratch))
        assert {r.event_id for r in index.read(spark, keys=few).collect()} >= {"evt-5", "evt-6", "evt-7"}
        assert sum(r.rows for r in runs) == n
    assert whole[1] > 5 * whole[0] and read[1] < 1.5 * read[0]


def test_many_buckets_are_read_whole(spark, scratch, monkeypatch):
    monkeypatch.setattr("vigil.streaming.runs.NAMED", 3)
    index = id_index(scratch, bucket_rows=10)
    index.add(ids(spark, 0, 200), 0)
    assert index.read(spark, keys=ids(spark, 0, 200)).count() == 200
    assert index.read(spark, keys=ids(spark, 0, 1)).count() < 200


# --- refined writer with index and status table

def cut(spark, pieces, seed):
    """The readings in pieces by arrival, cut at random places."""
    rng = random.Random(seed)
    at = [0, *sorted(rng.sample(range(1, 1000), pieces - 1)), 10 ** 9]
    t = tel.telemetry(spark, SF_SMALL)
    return [t.where(f"arrival_seq >= {a} AND arrival_seq < {b}") for a, b in zip(at, at[1:])]


def test_indexed_writer_equals_batch_whatever_is_sent_again(spark, scratch):
    writer = medallion.RefinedWriter(f"{scratch}/out", index=id_index(f"{scratch}/ids", fanout=2), status=medallion.status_table(f"{scratch}/status", fanout=2))
    pieces = cut(spark, 5, seed=3)
    for i, p in enumerate(pieces):
        again = pieces[0].where("arrival_seq % 3 = 0") if i else pieces[0].limit(0)
        writer(p.union(again), i)
    writer(pieces[-1], 4)  # replayed
    cols = ["arrival_seq", "event_id", "device_id", "event_timestamp", "temperature", "machine_status"]
    want = refine.refined(spark, SF_SMALL)
    assert sorted(map(tuple, spark.read.parquet(writer.refined_path).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    status = writer.status.read(spark).select(*latest.STATUS_COLUMNS)
    assert sorted(map(tuple, status.collect())) == sorted(map(tuple, latest.merge_snapshot(None, want).collect()))
    assert not os.path.exists(f"{scratch}/out/current_status") and not os.path.exists(f"{scratch}/out/ids")


def test_a_batch_of_many_days_has_few_files(spark, scratch):
    """A file per day and not one of every task: its small rows need no more, and the next readers open all of them."""
    rows = [{"device_id": f"M{i % 7}", "event_timestamp": f"2026-0{1 + i % 3}-{1 + i % 28:02d}T18:30:00Z"} for i in range(2_000)]
    writer = medallion.RefinedWriter(f"{scratch}/out", index=id_index(f"{scratch}/ids"))
    writer(readings(spark, rows).repartition(8), 0)
    files = glob.glob(f"{writer.refined_path}/batch_id=0/event_date=*/*.parquet")
    assert len({os.path.dirname(f) for f in files}) == 84 and len(files) <= 2 * 84
    assert spark.read.parquet(writer.refined_path).count() == 2_000


def test_a_late_batch_does_not_roll_a_device_back(spark, scratch):
    table = medallion.status_table(scratch)
    rows = [{"event_timestamp": f"2026-09-13T18:{m:02d}:00Z", "temperature": float(m)} for m in (30, 10)]
    for i, r in enumerate(rows):
        valid, _ = quality.split(quality.check(readings(spark, [r])))
        from vigil.operators import enrich
        table.add(latest.merge_snapshot(None, enrich.project_refined(enrich.enrich(valid))), i)
    assert [r.temperature for r in table.read(spark).collect()] == [30.0] and len(table.runs(spark)) == 2


# --- replayed pieces

def test_pieces_are_cut_into_files_of_bounded_rows(spark, scratch, monkeypatch):
    import pyarrow.parquet as pq

    from vigil.plans import stream_runs
    monkeypatch.setattr(stream_runs, "PIECE_ROWS", 50)
    wanted = tel.table(spark, SF_SMALL, "events").count()
    for name, run in (("in", lambda root, start: stream_runs.in_pieces(spark, SF_SMALL, root, 3, start)),
                      ("quarters", lambda root, start: [stream_runs._finish(start(s)) for s in stream_runs._quarters(spark, SF_SMALL, root)])):
        root, got = f"{scratch}/{name}", []

        def start(stream):
            return medallion.triggered(stream.writeStream.foreachBatch(lambda b, _: got.append(b.count())).option("checkpointLocation", f"{root}/ck"), True).start()

        run(root, start)
        sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{root}/events/*.parquet")]
        assert sum(got) == sum(sizes) == wanted and max(sizes) <= 50


def test_folders_are_listed_in_a_few_tasks_a_core(spark, scratch):
    from vigil.plans import stream_runs
    sc, own = spark.sparkContext, spark.conf.get(stream_runs.LISTING)
    few = 8 * sc.defaultParallelism
    refined_rows(spark, f"{scratch}/one", [{}], 0)
    for day in range(few + 20):
        shutil.copytree(f"{scratch}/one", f"{scratch}/refined/batch_id=0/event_date={day}")
    tasks = []

    def start(stream):
        sc.setJobGroup(scratch, "listing")
        stream_runs.refined_replay(spark, f"{scratch}/refined")
        sc.setLocalProperty("spark.jobGroup.id", None)
        status = sc.statusTracker()
        tasks.extend(status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup(scratch) for s in status.getJobInfo(j).stageIds)
        return medallion.triggered(stream.writeStream.foreachBatch(lambda *_: None).option("checkpointLocation", f"{scratch}/ck"), True).start()

    stream_runs.in_pieces(spark, SF_SMALL, f"{scratch}/in", 1, start)
    assert tasks and max(tasks) == few and spark.conf.get(stream_runs.LISTING) == own


# --- wear in the state store

def refined_rows(spark, folder, rows, part):
    """Appends readings as one file of refined rows to a folder that a stream follows."""
    from vigil.operators import enrich
    df = readings(spark, rows) if isinstance(rows, list) else rows
    enrich.project_refined(enrich.enrich(quality.split(quality.check(df))[0])).coalesce(1).write.mode("append").parquet(folder)


def run_wear(spark, folder, table, checkpoint, **options):
    from vigil.plans import stream_runs
    q = wear.start_wear(stream_runs.refined_replay(spark, folder), table, checkpoint, **options)
    q.awaitTermination()
    assert q.exception() is None


LIFE = ["device_id", "total_cycles", "running_cycles", "accumulated_vibration", "high_temp_cycles", "high_pressure_cycles", "last_status", "maintenance_required",
        "maintenance_reasons", "health_score"]


def life(df):
    return sorted((tuple(r) for r in df.select(*LIFE).collect()), key=str)


def test_wear_over_pieces_restarts_and_a_hot_device(spark, scratch):
    rng = random.Random(7)
    rows = [{"arrival_seq": i, "event_id": f"e{i}", "device_id": "HOT" if i % 3 == 0 else f"M{i % 17}", "vibration": round(rng.random() * 3, 2), "temperature": rng.choice([60.0, 80.0]),
             "pressure": rng.choice([4.0, 5.5]), "status": "FAILURE" if i in (2_000, 2_001) else rng.choice(["RUNNING", "STOPPED"])} for i in range(36_000)]
    cuts = [0, 5, 6, 900, 35_000, 36_000]
    table = wear.wear_table(f"{scratch}/wear", fanout=3)
    touched = []
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        refined_rows(spark, f"{scratch}/refined", rows[a:b], n)
        run_wear(spark, f"{scratch}/refined", table, f"{scratch}/ck")
        touched.append(max(table.runs(spark), key=lambda r: r.batch).rows)
    assert touched == [len({r["device_id"] for r in rows[a:b]}) for a, b in zip(cuts, cuts[1:])]
    whole = spark.read.parquet(f"{scratch}/refined")
    state = table.read(spark)
    assert life(wear.wear_view(state)) == life(consumers.lifecycle_by_device(whole))
    cols = ["work_order_id", "device_id", "trigger_event_id", "priority", "health_score", "reasons"]
    assert sorted(wear.wear_orders(state).select(*cols).collect()) == sorted(consumers.work_orders(consumers.maintenance_state(whole)).select(*cols).collect())


def test_wear_runs_whatever_store_the_session_names(spark, scratch):
    own = spark.conf.get(wear.PROVIDER)
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    table = wear.wear_table(f"{scratch}/wear")
    spark.conf.set(wear.PROVIDER, other)
    try:
        for n in range(2):
            refined_rows(spark, f"{scratch}/in", [{"arrival_seq": n, "event_id": f"s{n}", "device_id": "A", "status": "FAILURE"}], n)
            run_wear(spark, f"{scratch}/in", table, f"{scratch}/ck")
        assert spark.conf.get(wear.PROVIDER) == other
    finally:
        spark.conf.set(wear.PROVIDER, own)
    assert [(r.device_id, r.total_cycles, r.failures) for r in table.read(spark).collect()] == [("A", 2, 2)]


def test_wear_processor_needs_no_package_on_the_workers(tmp_path):
    """Read and run where this package cannot be imported, as in a worker without it."""
    (tmp_path / "p.bin").write_bytes(cloudpickle.dumps(wear.Wear(10_000, 20, None)))
    code = """
import pandas as pd
from pyspark import cloudpickle
class State:
    kept = None
    def exists(self): return self.kept is not None
    def get(self): return self.kept
    def update(self, v): self.kept = v
p = cloudpickle.loads(open("p.bin", "rb").read())
p.state = State()
rows = pd.DataFrame([("A", 1, "e1", "RUNNING", 300, True, False), ("A", 2, "e2", "FAILURE", 200, False, True)],
                    columns=["device_id", "seq", "event_id", "status", "cents", "hot", "pressed"])
print(*next(p.handleInputRows(("A",), iter([rows]), None)).iloc[0][["total_cycles", "cents", "failures", "order_event_id"]])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert got.stdout.split() == ["2", "500", "1", "e2"], got.stderr


class Kept:
    """The state of a processor: of one device, or by device in a map."""

    def __init__(self):
        self.kept = {}

    def exists(self):
        return None in self.kept

    def get(self):
        return self.kept.get(None)

    def update(self, value):
        self.kept[None] = value

    def getValue(self, key):
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.kept[key] = value


def test_a_group_of_many_devices_is_added_up_at_once():
    """One call and one frame for all devices of a group, with the rows that each device by itself gives."""
    rng = random.Random(3)
    dealt, alone = wear.DealtWear(900, 4, None), {}
    dealt.state = Kept()
    columns = ["device_id", "seq", "event_id", "status", "cents", "hot", "pressed"]
    for n in range(5):
        rows = pd.DataFrame([(f"M{rng.randrange(40 if n else 9)}", rng.choice([None, rng.randrange(10 ** 4)]) if n == 3 else 10 ** 4 * (4 - n) + i if n == 4 else 10 ** 4 * n + 500 - i, f"e{n}-{i}",
                              rng.choice(["RUNNING"] * 30 + ["STOPPED", "FAILURE"]), rng.randrange(-50, 100), rng.random() < 0.1, rng.random() < 0.2) for i in range(300)], columns=columns)
        frames = list(dealt.handleInputRows((7,), iter([rows[:120], rows[120:]]), None))
        assert len(frames) == 1 and frames[0].device_id.is_unique and set(frames[0].device_id) == set(rows.device_id)
        got = {r[0]: tuple(None if pd.isna(v) else v for v in r) for r in frames[0].itertuples(index=False, name=None)}
        for device, own in rows.groupby("device_id"):
            if device not in alone:
                alone[device] = wear.Wear(900, 4, None)
                alone[device].state = Kept()
            (frame,) = alone[device].handleInputRows((device,), iter([own]), None)
            assert got[device] == tuple(None if pd.isna(v) else v for v in frame.iloc[0])
            assert dealt.state.kept[(device,)] == got[device][1:] and all(type(v) in (int, str, type(None)) for v in dealt.state.kept[(device,)])
    assert len(alone) > 30 and {v[TOTAL["order_seq"]] is None for v in dealt.state.kept.values()} == {True, False}


TOTAL = {name: i for i, name in enumerate(wear.STATE.names[1:])}


def test_wear_of_many_devices_in_few_groups_equals_batch(spark, scratch, monkeypatch):
    monkeypatch.setattr(wear, "GROUPS", 3)
    rng = random.Random(11)
    rows = [{"arrival_seq": 2 ** 53 + 2 * i + 1, "event_id": f"g{i}", "device_id": f"M{rng.randrange(60)}", "vibration": round(rng.random() * 9, 2), "temperature": rng.choice([60.0, 80.0]),
             "status": rng.choice(["RUNNING"] * 40 + ["FAILURE"])} for i in range(1_200)]
    first, second = wear.wear_table(f"{scratch}/one"), wear.wear_table(f"{scratch}/two")
    for n, (a, b) in enumerate([(0, 100), (100, 400), (400, 1_200)]):
        refined_rows(spark, f"{scratch}/refined-{n // 2}", rows[a:b], n)
        run_wear(spark, f"{scratch}/refined-{n // 2}", second if n == 2 else first, f"{scratch}/ck{n // 2}", **({"initial": first.read(spark)} if n == 2 else {}))
    whole = spark.read.parquet(f"{scratch}/refined-0", f"{scratch}/refined-1")
    assert spark.read.parquet(f"{scratch}/refined-1").select("device_id").distinct().count() == 60
    state = second.read(spark)
    assert any(r.order_seq is None for r in first.read(spark).collect())  # among orders
    assert life(wear.wear_view(state)) == life(consumers.lifecycle_by_device(whole))
    cols = ["work_order_id", "device_id", "trigger_event_id", "priority", "health_score", "reasons"]
    assert sorted(wear.wear_orders(state).select(*cols).collect()) == sorted(consumers.work_orders(consumers.maintenance_state(whole)).select(*cols).collect())
    assert {r.order_seq for r in state.collect() if r.order_seq is not None} <= {r["arrival_seq"] for r in rows}


def test_wear_starts_from_a_snapshot(spark, scratch):
    rows = [{"device_id": d, "vibration": 60.0, "temperature": 80.0} for d in ("A", "B")]
    first, second = wear.wear_table(f"{scratch}/one"), wear.wear_table(f"{scratch}/two")
    refined_rows(spark, f"{scratch}/a", rows, 0)
    run_wear(spark, f"{scratch}/a", first, f"{scratch}/ck1")
    more = [{"arrival_seq": 10 + i, "event_id": f"x{i}", **r} for i, r in enumerate(rows[:1])]
    refined_rows(spark, f"{scratch}/b", more, 0)
    run_wear(spark, f"{scratch}/b", second, f"{scratch}/ck2", initial=first.read(spark))
    got = {r.device_id: r for r in wear.wear_view(second.read(spark)).collect()}
    assert list(got) == ["A"] and got["A"].total_cycles == 2 and got["A"].accumulated_vibration == 120.0 and got["A"].maintenance_required
    with pytest.raises(ValueError):
        wear.start_wear(first.read(spark), first, f"{scratch}/ck3", ttl=1)


def test_expired_state_starts_anew(spark, scratch):
    from vigil.plans import stream_runs
    table = wear.wear_table(f"{scratch}/table")
    refined_rows(spark, f"{scratch}/in", [{"arrival_seq": 0, "event_id": "y0", "device_id": "A"}], 0)
    q = wear.start_wear(stream_runs.refined_replay(spark, f"{scratch}/in"), table, f"{scratch}/ck", ttl=1, available_now=False, interval="1 second")
    try:
        for part in (1, 2):
            for _ in range(60):
                if len(table.runs(spark)) >= part:
                    break
                time.sleep(1)
            if part == 1:
                refined_rows(spark, f"{scratch}/in", [{"arrival_seq": 1, "event_id": "y1", "device_id": "A"}], 1)
        assert [(r.last_seq, r.total_cycles) for r in table.read(spark).collect()] == [(1, 1)]
    finally:
        q.stop()


# --- values that go on over micro-batches

@pytest.mark.parametrize("seed", [1, 2])
def test_dead_letters_are_numbered_over_batches(spark, scratch, seed):
    writer = carried.DeadLetters(f"{scratch}/out", threshold=4, span=50)
    pieces = [quality.quarantine(quality.split(quality.check(p))[1]) for p in cut(spark, 6, seed)]
    for i, p in enumerate([*pieces[:3], pieces[2].limit(0), *pieces[3:]]):
        writer(p, i)
        if i in (1, 6):
            writer(p, i)  # replayed
    q = refine.quarantine_from(tel.telemetry(spark, SF_SMALL))
    for name, want, cols in (("records", consumers.dlq_records(q), ["arrival_seq", "quarantine_id", "event_id", "device_id", "error_reason"]),
                             ("alarms", consumers.dlq_alarms(q, 4), ["error_reason", "alarm_at", "event_id", "device_id"])):
        assert sorted(map(tuple, writer.read(spark, name).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_running_values_over_batches(spark, scratch, seed):
    metrics, average = carried.RunningMetrics(f"{scratch}/m", span=100), carried.MovingAverage(f"{scratch}/a", n=4, span=100)
    for i, p in enumerate(cut(spark, 5, seed)):
        for writer in (metrics, average):
            writer(p, i)
            if i in (2, 4):
                writer(p, i)  # replayed
    t = tel.telemetry(spark, SF_SMALL)
    key = lambda r: (r.arrival_seq, r.device_id)
    assert sorted(metrics.read(spark).collect(), key=key) == sorted(consumers.running_metrics(t).collect(), key=key)
    assert sorted(average.read(spark).collect(), key=key) == sorted(windows.moving_avg(t, 4).collect(), key=key)


def test_moving_average_numbers_its_rows_once(spark):
    df = spark.range(300).selectExpr("id AS arrival_seq", "concat('d', id % 2) AS device_id", "CAST(id AS DOUBLE) AS temperature")
    small, plain = (sorted(map(tuple, windows.moving_avg(df, 5, block=b).collect())) for b in (7, 1 << 20))
    assert small == plain
    plan = windows.moving_avg(df, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 300") == 2  # the scan's rows and its chunk totals
