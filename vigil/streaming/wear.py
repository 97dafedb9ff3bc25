"""Maintenance wear as a keyed stateful operator: totals per device live in the state store, not in a snapshot table.

``wear_stream`` deals refined readings by device into ``GROUPS`` groups and keeps a map in each, one value per device
(``transformWithStateInPandas``; ``start_wear`` runs it on RocksDB, the only store that has this operator's state, whatever
store the session names): totals, the running peak of the accumulated vibration, and the first reading that required
maintenance, latched. A micro-batch touches the state of its own devices only, and gives one row for each of them. Spark hands
a group over at a time, which costs a frame in and a frame out; so a group holds many devices, whose readings are added up
together. The state starts from a snapshot if there is one (``initial``), survives restarts with the checkpoint, and may
expire (``ttl``, of devices not heard of).

Numbers are exact: vibration is counted in whole hundredths, and scores and reasons are computed by Spark from the totals
(``wear_view``), with the batch operator's expressions.

A group's readings of one micro-batch are held by one task, seven narrow columns each, to be put in arrival order. The source's
bound on a micro-batch (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``) bounds that; ``MaintenanceWriter`` is the form
without this bound, with a prefix scan over each micro-batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from vigil.functions import text
from vigil.operators import consumers
from vigil.streaming.medallion import INTERVAL, triggered
from vigil.streaming.runs import RunTable

# the processor travels to the workers by value: its methods name nothing else of this package, which workers need not have
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FAILURE, RUNNING = consumers.FAILURE, consumers.RUNNING
#: Groups that devices are dealt into; a checkpoint's state is kept by them, so the number holds for its life.
GROUPS = 1 << 11

TOTALS = ["total_cycles", "running_cycles", "cents", "peak_cents", "high_temp_cycles", "high_pressure_cycles", "failures"]
#: The state of a device; order_* describe the reading that required maintenance first.
STATE = StructType().add("device_id", "string")
for _name in [*TOTALS, "last_seq", "last_status", "order_seq", "order_event_id", "order_cycles", "order_cents", "order_hot", "order_status"]:
    STATE.add(_name, "string" if _name in ("last_status", "order_event_id", "order_status") else "long")


def _latest(rows: DataFrame) -> DataFrame:
    """A device's newest row: the latest reading's, and of those the one with the most readings (late ones were added)."""
    g = rows.groupBy("device_id").agg(F.max_by(F.struct(*STATE.names[1:]), F.struct("last_seq", "total_cycles")).alias("s"))
    return g.select("device_id", "s.*")


def wear_table(root: str, **options) -> RunTable:
    """Where the operator's rows go: a run of the devices that each micro-batch had."""
    return RunTable(root, STATE, "device_id", _latest, **options)


def _inputs(df: DataFrame, lim: consumers.WearLimits, order: str) -> DataFrame:
    n = text.fnum
    return consumers.normalize(df).selectExpr(
        "device_id", f"CAST({order} AS BIGINT) AS seq", "event_id", "status", "CAST(CAST(vibration AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents",
        f"temperature > {n(lim.hot_temperature)}D AS hot", f"pressure > {n(lim.high_pressure)}D AS pressed")


class Wear(StatefulProcessor):
    """Adds a micro-batch's readings to the state of their devices; one row per device that had any. The state is one device's,
    the group's; ``DealtWear`` has groups of many."""

    def __init__(self, limit_cents: int, limit_hot: int, ttl_ms: int | None):
        self.limit_cents, self.limit_hot, self.ttl_ms = limit_cents, limit_hot, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("wear", StructType(STATE.fields[1:]), self.ttl_ms)

    def _get(self, device: str) -> tuple | None:
        return self.state.get() if self.state.exists() else None

    def _put(self, device: str, values: tuple) -> None:
        self.state.update(values)

    def handleInitialState(self, key, initial: pd.DataFrame, timer_values) -> None:
        for row in initial[STATE.names].itertuples(index=False, name=None):
            plain = [_plain(v) for v in row]
            self._put(row[0], tuple(int(v) if v is not None and f.dataType.typeName() == "long" else v for f, v in zip(STATE, plain))[1:])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows, ignore_index=True)
        code, devices = pd.factorize(batch.device_id)
        seq = pd.to_numeric(batch.seq).to_numpy()
        if seq.dtype.kind == "f":  # a missing number is the first
            seq = np.where(np.isnan(seq), -np.inf, seq)
        order = np.lexsort((seq, code))  # by device, and each one's in arrival order
        seq, status, event = seq[order], batch.status.to_numpy(dtype=object)[order], batch.event_id.to_numpy(dtype=object)[order]
        first = np.searchsorted(code[order], np.arange(len(devices)))
        n = np.diff(np.append(first, len(batch)))
        before = [self._get(d) for d in devices]
        before = [dict.fromkeys(TOTALS, 0) | {"peak_cents": None} if v is None else dict(zip(STATE.names[1:], v)) for v in before]

        def running(column, carried: str):
            """Sums after each reading, from what its device had before."""
            values = pd.to_numeric(column).fillna(0).to_numpy().astype(np.int64)[order]
            sums = values.cumsum()
            had = np.array([b[carried] for b in before], dtype=np.int64)
            return sums + np.repeat(had - sums[first] + values[first], n)

        def counted(which) -> list[int]:
            return np.add.reduceat(which, first, dtype=np.int64).tolist()

        cents, hot, failed = running(batch.cents, "cents"), running(batch.hot, "high_temp_cycles"), status == FAILURE
        due = np.flatnonzero((cents >= self.limit_cents) | (hot >= self.limit_hot) | failed)
        due = np.append(due, len(batch))[np.searchsorted(due, first)].tolist()  # each device's first, or one of the next device's
        peak, last, n = np.maximum.reduceat(cents, first).tolist(), (first + n - 1).tolist(), n.tolist()
        ran, pressed, failures = counted(status == RUNNING), counted(batch.pressed.to_numpy(dtype=bool)[order]), counted(failed)
        out = []
        for k, (device, now) in enumerate(zip(devices, before)):
            i, end = due[k], last[k]
            if now.get("order_cycles") is None and i <= end:
                now |= {"order_seq": _number(seq[i]), "order_event_id": event[i], "order_cycles": now["total_cycles"] + i - int(first[k]) + 1,
                        "order_cents": int(cents[i]), "order_hot": int(hot[i]), "order_status": status[i]}
            now["peak_cents"] = peak[k] if now["peak_cents"] is None else max(now["peak_cents"], peak[k])
            now["total_cycles"] += n[k]
            now["running_cycles"] += ran[k]
            now["high_pressure_cycles"] += pressed[k]
            now["failures"] += failures[k]
            now["cents"], now["high_temp_cycles"] = int(cents[end]), int(hot[end])
            number, latest = _number(seq[end]), now.get("last_seq")
            if latest is None or number is not None and number >= latest:  # a reading that comes late does not change the last status
                now |= {"last_seq": number, "last_status": status[end]}
            values = tuple(_plain(now.get(c)) for c in STATE.names[1:])
            self._put(device, values)
            out.append((device, *values))
        yield pd.DataFrame({f.name: pd.array(c, dtype="Int64") if f.dataType.typeName() == "long" else list(c) for f, c in zip(STATE, zip(*out))})


class DealtWear(Wear):
    """The same over groups of many devices: the state of each is an entry of its group's map, with an expiry of its own."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("wear", StructType(STATE.fields[:1]), StructType(STATE.fields[1:]), self.ttl_ms)

    def _get(self, device: str) -> tuple | None:
        return self.state.getValue((device,))

    def _put(self, device: str, values: tuple) -> None:
        self.state.updateValue((device,), values)


def _plain(v):
    return None if v is None or v is pd.NA or v != v else v.item() if hasattr(v, "item") else v


def _number(seq) -> int | None:
    return None if seq == -np.inf else int(seq)


def _dealt(df: DataFrame) -> GroupedData:
    return df.withColumn("_group", F.pmod(F.xxhash64("device_id"), F.lit(GROUPS)).cast("int")).groupBy("_group")


def wear_stream(refined: DataFrame, lim: consumers.WearLimits = consumers.WEAR, order: str = "arrival_seq", ttl: int | None = None,
                initial: DataFrame | None = None) -> DataFrame:
    """A row of ``STATE`` for each device that a micro-batch has readings of, after them (update mode). ``ttl``: milliseconds
    after which the state of a device that sends nothing is dropped; ``initial``: rows of ``STATE`` to start from."""
    processor = DealtWear(int(round(lim.max_accumulated_vibration * 100)), int(lim.max_high_temp_cycles), ttl)
    if initial is not None:  # as text, for pandas makes floats of whole numbers among missing ones
        initial = _dealt(initial.select([F.col(f.name).cast("string") for f in STATE]))
    return _dealt(_inputs(refined, lim, order)).transformWithStateInPandas(processor, STATE, "Update", "ProcessingTime" if ttl else "None", initialState=initial)


def wear_view(state: DataFrame, lim: consumers.WearLimits = consumers.WEAR) -> DataFrame:
    """The life cycle by device (as ``consumers.lifecycle_by_device``) of rows of ``STATE``."""
    acc = "CAST({} / 100 AS DECIMAL(28,2))"
    reasons = consumers.maintenance_reasons_sql("_order_acc", "order_hot", "order_status", lim)
    rows = state.withColumns({"_acc": F.expr(acc.format("CAST(cents AS DECIMAL(20,0))")), "_order_acc": F.expr(acc.format("CAST(order_cents AS DECIMAL(20,0))"))})
    return consumers.snapshot_view(rows.withColumn("maintenance_reasons", F.expr(f"CASE WHEN order_cycles IS NOT NULL THEN {reasons} END")), lim)


def wear_orders(state: DataFrame, lim: consumers.WearLimits = consumers.WEAR) -> DataFrame:
    """The work orders of rows of ``STATE``: one per device that has required maintenance, as it was at that reading."""
    at = state.where("order_cycles IS NOT NULL").selectExpr(
        "device_id", "order_seq AS arrival_seq", "order_event_id AS event_id", "order_cycles AS total_cycles", "order_status AS last_status",
        "CAST(CAST(order_cents AS DECIMAL(20,0)) / 100 AS DECIMAL(28,2)) AS _acc", "order_hot AS high_temp_cycles")
    at = at.withColumns({"health_score": F.expr(consumers.health_score_sql(lim=lim)), "reasons": F.expr(consumers.maintenance_reasons_sql(status="last_status", lim=lim))})
    return consumers.work_orders(at)


def start_wear(refined: DataFrame, table: RunTable, checkpoint: str, lim: consumers.WearLimits = consumers.WEAR, ttl: int | None = None,
               initial: DataFrame | None = None, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    """Keeps ``table`` (``wear_table``) at the state of the devices in ``refined``; a micro-batch writes its own devices. With a
    ``ttl`` Spark goes on making micro-batches to expire state, so such a query has no end to run to."""
    if ttl and available_now:
        raise ValueError("a query whose state expires runs on: available_now=False")
    w = (wear_stream(refined, lim, ttl=ttl, initial=initial).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, batch_id: table.add(batch, batch_id)))
    # a query takes the session's settings when it starts; other queries keep the store they have
    conf = refined.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:
        return triggered(w, available_now, interval).start()
    finally:
        conf.set(PROVIDER, before)
