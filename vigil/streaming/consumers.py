"""Consumer streaming queries, each with its own checkpoint (the equivalent of one consumer group per consumer).

alerts       stateless: filter + projection -> JSON append sink
metrics      stateful aggregate per (device, status) (complete mode) -> versioned snapshots of the devices (with their
             status maps) and of the fleet
dlq          stateful counts of rejects per (reason, device) (complete mode) -> versioned snapshots by reason, by device
             and in total
archive      raw envelope -> JSON sink partitioned by year/month/day
maintenance  MaintenanceWriter: prior snapshot + this batch -> state rows, new work orders (latched once per
             device), next snapshot. Arrival-ordered, as the source consumer; wire it downstream of the refined
             writer (same micro-batch) or over an ordered stream of refined rows.
late demo    watermark + tumbling window in append mode: rows behind the watermark are dropped, not counted
             (Spark filters late rows against the watermark of the batch before the previous one)

``start_consumers`` starts any subset by name on one session (fan-out); ``spark.streams.awaitAnyTermination()``
supervises them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.functions import rules
from vigil.operators import consumers, quality
from vigil.sources import fs
from vigil.streaming.medallion import INTERVAL, triggered

NAMES = ("alerts", "metrics", "archive", "dlq", "maintenance")


def start_alerts(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    w = (consumers.alerts(stream).writeStream.format("json").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    return triggered(w, available_now, interval).start()


def write_version(df: DataFrame, path: str, version: int, keep: int = 3) -> None:
    """``df`` as snapshot ``v=<version>`` of ``path``; the newest ``keep`` stay."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    old = [v for v in fs.partition_values(spark, path, "v") if v < version]
    for v in old[:-max(keep - 1, 1)]:
        fs.delete(spark, f"{path}/v={v}")


class MetricsWriter:
    """foreachBatch over ``metrics_by_status`` (complete): devices -> ``<path>/v=<n>``, totals -> ``<path>/fleet/v=<n>``."""

    def __init__(self, path: str, keep: int = 3):
        self.path, self.keep = path.rstrip("/"), keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_version(consumers.metrics_snapshot(batch), self.path, batch_id, self.keep)
        devices = batch.sparkSession.read.parquet(f"{self.path}/v={batch_id}")
        write_version(consumers.fleet_of(devices), f"{self.path}/fleet", batch_id, self.keep)


class DlqWriter:
    """foreachBatch over counts by (reason, device) (complete): ``<path>/by_reason``, ``by_device`` and ``summary``."""

    def __init__(self, path: str, keep: int = 3):
        self.path, self.keep = path.rstrip("/"), keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for view, df in consumers.dlq_views(batch).items():
            write_version(df, f"{self.path}/{view}", batch_id, self.keep)


def start_dlq(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    """Dead-letter statistics of the readings that fail the quality check."""
    _, invalid = quality.split(quality.check(stream))
    counts = consumers.dlq_counts(quality.quarantine(invalid))
    w = counts.writeStream.outputMode("complete").foreachBatch(DlqWriter(path)).option("checkpointLocation", checkpoint)
    return triggered(w, available_now, interval).start()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    versions = fs.partition_values(spark, path, "v")
    return spark.read.parquet(f"{path}/v={versions[-1]}") if versions else None


def start_metrics(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    w = (consumers.metrics_by_status(stream).writeStream.outputMode("complete").foreachBatch(MetricsWriter(path))
         .option("checkpointLocation", checkpoint))
    return triggered(w, available_now, interval).start()


def start_archive(stream: DataFrame, path: str, checkpoint: str, topic: str = consumers.DEFAULT_TOPIC,
                  available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    w = (consumers.archive_records(stream, topic).writeStream.format("json").outputMode("append")
         .partitionBy("year", "month", "day").option("checkpointLocation", checkpoint).option("path", path))
    return triggered(w, available_now, interval).start()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read the archive back; partition values stay zero-padded strings (explicit schema, no inference)."""
    from vigil.sources import schemas
    return spark.read.schema(schemas.ARCHIVE).json(path)


class MaintenanceWriter:
    """foreachBatch: carries per-device wear totals and the latched work order from batch to batch."""

    def __init__(self, root: str, limits: consumers.WearLimits = consumers.WEAR, order: str = "arrival_seq", keep: int = 3):
        self.root, self.limits, self.order, self.keep = root.rstrip("/"), limits, order, keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snap_path = f"{self.root}/snapshot"
        versions = [v for v in fs.partition_values(spark, snap_path, "v") if v < batch_id]
        prior = spark.read.parquet(f"{snap_path}/v={versions[-1]}") if versions else None
        state = consumers.maintenance_state(batch, self.limits, self.order, prior=prior).persist()
        try:
            latched = prior.filter(F.col("maintenance_reasons").isNotNull()) if prior is not None else None
            orders = consumers.work_orders(state, self.order, latched)
            orders.write.mode("overwrite").parquet(f"{self.root}/work_orders/batch_id={batch_id}")
            new_orders = spark.read.parquet(f"{self.root}/work_orders/batch_id={batch_id}")
            (state.drop("_acc", "_peak", "_failures").write.mode("overwrite")
                  .parquet(f"{self.root}/state_rows/batch_id={batch_id}"))
            snap = consumers.maintenance_snapshot(state, prior, new_orders, self.order, self.limits)
            write_version(snap, snap_path, batch_id, self.keep)
        finally:
            state.unpersist()


def start_maintenance(refined_stream: DataFrame, root: str, checkpoint: str,
                      limits: consumers.WearLimits = consumers.WEAR, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    """Maintenance over a stream of refined rows (e.g. a topic, per-device ordered). Over a *file* stream of the
    refined table, files are not arrival-ordered; there the preferred wiring is
    ``RefinedWriter(downstream=[MaintenanceWriter(root)])``, which sees each refined micro-batch whole."""
    w = refined_stream.writeStream.foreachBatch(MaintenanceWriter(root, limits)).option("checkpointLocation",
                                                                                         checkpoint)
    return triggered(w, available_now, interval).start()


def late_window_counts(stream: DataFrame, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Tumbling counts per device with a watermark: rows older than the watermark are dropped, not counted."""
    valid = stream.withColumn("event_ts", rules.parsed_time(F.col("event_timestamp"))).filter(
        F.col("event_ts").isNotNull())
    g = (valid.withWatermark("event_ts", delay).groupBy(F.window("event_ts", width).alias("w"), "device_id")
              .agg(F.count(F.lit(1)).alias("n")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "device_id", "n")


def start_late_demo(stream: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes",
                    available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    w = (late_window_counts(stream, delay).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    return triggered(w, available_now, interval).start()


def start_consumers(spark: SparkSession, stream: DataFrame, root: str, names=NAMES,
                    refined_stream: DataFrame | None = None, available_now: bool = True,
                    interval: str = INTERVAL) -> dict[str, StreamingQuery]:
    """Start the named consumers on one session, each with its own output and checkpoint under ``root``. Maintenance
    reads ``refined_stream`` if there is one, else the readings themselves."""
    root = root.rstrip("/")
    out: dict[str, StreamingQuery] = {}
    for name in names:
        ck = f"{root}/_checkpoints/{name}"
        if name == "maintenance":
            out[name] = start_maintenance(stream if refined_stream is None else refined_stream, f"{root}/maintenance", ck,
                                          available_now=available_now, interval=interval)
        elif name in NAMES:
            start = {"alerts": start_alerts, "metrics": start_metrics, "archive": start_archive, "dlq": start_dlq}[name]
            out[name] = start(stream, f"{root}/{name}", ck, available_now=available_now, interval=interval)
        else:
            raise ValueError(f"unknown consumer {name!r}; choose from {NAMES}")
    return out
