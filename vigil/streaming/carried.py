"""Running values that go on over micro-batches: numbers, alarms, summaries and averages after every reading.

Each writer takes a micro-batch whole (``foreachBatch``), computes its running values with the batch operators (chunked prefix
scans, so no key is in one task) and adds what earlier batches carry: a count, a device's totals, or its last n - 1 readings.
What is carried is a run table (``runs``): a batch reads the keys that it has and writes those. Every write belongs to
the batch's number and the carry is read from batches before it, so a replayed batch replaces itself and changes nothing.
The results equal the batch operators' over all readings, however the stream is cut, as long as batches come in arrival
order (a topic's do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil.operators import consumers, quality, scan, windows
from vigil.streaming.medallion import INTERVAL, triggered
from vigil.streaming.runs import RunTable


def _schema(**columns: str) -> StructType:
    out = StructType()
    for name, kind in columns.items():
        out.add(name, kind)
    return out


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("error_reason").agg(F.sum("n").alias("n"))


class DeadLetters:
    """Numbers rejects ``dlq-1``, ``dlq-2``, ... over all micro-batches (``<root>/records``) and raises one alarm per reason, at the
    very record that brings it to ``threshold`` (``<root>/alarms``)."""

    def __init__(self, root: str, threshold: int = consumers.DLQ_ALARM_THRESHOLD, order: str = "arrival_seq", span: int | None = None):
        self.root, self.threshold, self.order, self.span = root.rstrip("/"), threshold, order, span
        self.counts = RunTable(f"{self.root}/counts", _schema(error_reason="string", n="long"), "error_reason", _sums)

    def __call__(self, rejects: DataFrame, batch_id: int) -> None:
        spark = rejects.sparkSession
        q = consumers.dlq_normalize(rejects).persist()
        try:
            if q.isEmpty():
                return
            before = self.counts.read(spark, before=batch_id).agg(F.sum("n")).first()[0] or 0
            (consumers.dlq_records(q, self.order, self.span, first=before + 1).write.mode("overwrite").parquet(f"{self.root}/records/batch_id={batch_id}"))
            new = q.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n")).persist()
            carried = self.counts.read(spark, before=batch_id, keys=new).withColumnRenamed("n", "had")
            # reasons that reach the threshold in this batch, and which of its records does it
            due = new.join(carried, "error_reason", "left").withColumn("had", F.expr("coalesce(had, 0L)")).where(f"had < {self.threshold} AND had + n >= {self.threshold}")
            due = due.select("error_reason", (F.lit(self.threshold) - F.col("had")).alias("nth"))
            numbered = scan.sequence(q.join(due, "error_reason"), "error_reason", self.order, "_n", span=self.span)
            alarms = numbered.where("_n = nth").select("error_reason", F.col(self.order).alias("alarm_at"), "event_id", "device_id")
            alarms.write.mode("overwrite").parquet(f"{self.root}/alarms/batch_id={batch_id}")
            self.counts.add(new, batch_id)
            new.unpersist()
        finally:
            q.unpersist()

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}").drop("batch_id")


class RunningMetrics:
    """A device's summary after each of its readings (``<root>/rows``), with its totals carried (``<root>/totals``)."""

    def __init__(self, root: str, order: str = "arrival_seq", span: int | None = None):
        self.root, self.order, self.span = root.rstrip("/"), order, span
        names = {"total_events": "long"}
        for m in consumers._METRICS:
            names |= {f"_s_{m}": "long", f"min_{m}": "double", f"max_{m}": "double"}
        # totals only grow, so a device's newest row is the one with the most events
        self.totals = RunTable(f"{self.root}/totals", _schema(device_id="string", **names), "device_id", self._newest)

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = self.totals.schema.names[1:]
        return rows.groupBy("device_id").agg(F.max_by(F.struct(*names), "total_events").alias("s")).select("device_id", "s.*")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        out = f"{self.root}/rows/batch_id={batch_id}"
        carried = self.totals.read(spark, before=batch_id, keys=consumers.normalize(batch))
        consumers.running_totals(batch, self.order, self.span, prior=carried).write.mode("overwrite").parquet(out)
        self.totals.add(self._newest(spark.read.parquet(out)), batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return consumers.running_view(spark.read.parquet(f"{self.root}/rows"), self.order)


class MovingAverage:
    """The average of a device's last ``n`` readings after each of them (``<root>/rows``), with its last n - 1 carried
    (``<root>/last``)."""

    def __init__(self, root: str, n: int = 10, value: str = "temperature", key: str = "device_id", order: str = "arrival_seq", span: int | None = None):
        self.root, self.n, self.value, self.key, self.order, self.span = root.rstrip("/"), n, value, key, order, span
        self.last = RunTable(f"{self.root}/last", _schema(**{key: "string", order: "long", value: "double"}), key, self._tail)

    def _tail(self, rows: DataFrame) -> DataFrame:
        """The last n - 1 rows of each key: a ranking with a limit, which mappers apply first."""
        rank = F.row_number().over(Window.partitionBy(self.key).orderBy(F.col(self.order).desc()))
        return rows.withColumn("_r", rank).where(F.col("_r") <= self.n - 1).drop("_r")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*self.last.schema.names).persist()
        try:
            if rows.isEmpty():
                return
            carried = self.last.read(spark, before=batch_id, keys=rows)
            both = carried.withColumn("_own", F.lit(False)).union(rows.withColumn("_own", F.lit(True)))
            out = windows.moving_avg(both, self.n, self.value, self.key, self.order, span=self.span, keep=("_own",))
            out.where("_own").drop("_own").write.mode("overwrite").parquet(f"{self.root}/rows/batch_id={batch_id}")
            self.last.add(self._tail(rows), batch_id)  # earlier ones lie in earlier runs
        finally:
            rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/rows").drop("batch_id")


def start_carried(stream: DataFrame, writer, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    """Readings (for ``DeadLetters`` those that fail the check are taken) into one of the writers."""
    if isinstance(writer, DeadLetters):
        stream = quality.quarantine(quality.split(quality.check(stream))[1])
    return triggered(stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint), available_now, interval).start()
