"""Late readings set aside instead of lost, and the progress of queries as a table.

Spark drops a reading from an event-time window that its watermark has closed, and only counts it. ``LateRouter`` takes
the same decision on whole readings: the watermark of a micro-batch is the latest event time of the batches before it, less
the delay, and a reading whose window ended by then goes to ``<root>/late`` with that watermark, all others to
``<root>/kept``. The latest time of each batch is kept under its number (``<root>/marks``), so a replayed batch decides as it
did before and replaces its own folders. Readings without a time belong to no window; they are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from vigil.functions import rules
from vigil.sources import fs
from vigil.streaming.medallion import INTERVAL, triggered


class LateRouter:
    """``foreachBatch``: readings behind the watermark of windows of ``width`` -> late, the others -> kept."""

    def __init__(self, root: str, delay: str = "10 minutes", width: str = "1 hour", ts: str = "event_timestamp"):
        self.root, self.delay, self.width, self.ts = root.rstrip("/"), delay, width, ts

    def watermark(self, spark: SparkSession, batch_id: int):
        """The latest event time of the batches before ``batch_id`` less the delay; none before the first with a time."""
        if not fs.partition_values(spark, f"{self.root}/marks", "batch_id"):
            return None
        marks = spark.read.schema("latest timestamp, batch_id bigint").parquet(f"{self.root}/marks")
        return marks.where(F.col("batch_id") < batch_id).agg(F.expr(f"max(latest) - INTERVAL {self.delay}")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        limit = self.watermark(spark, batch_id)
        timed = batch.withColumn("_t", rules.parsed_time(F.col(self.ts))).persist()
        try:
            closed = F.coalesce(F.window("_t", self.width).end <= F.lit(limit), F.lit(False)) if limit is not None else F.lit(False)
            # window() leaves out rows without a time, so these are put beside it
            marked = timed.where("_t IS NOT NULL").withColumn("_late", closed).unionByName(timed.where("_t IS NULL").withColumn("_late", F.lit(False)))
            marked.where("NOT _late").drop("_t", "_late").write.mode("overwrite").parquet(f"{self.root}/kept/batch_id={batch_id}")
            late = marked.where("_late").drop("_late").withColumnRenamed("_t", "event_ts").withColumn("watermark", F.lit(limit).cast("timestamp"))
            late.write.mode("overwrite").parquet(f"{self.root}/late/batch_id={batch_id}")
            timed.agg(F.max("_t").alias("latest")).write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")
        finally:
            timed.unpersist()

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}").drop("batch_id")


def start_late_router(stream: DataFrame, router: LateRouter, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    return triggered(stream.writeStream.foreachBatch(router).option("checkpointLocation", checkpoint), available_now, interval).start()


class ProgressLog(StreamingQueryListener):
    """What each micro-batch of the session's queries reported; ``spark.streams.addListener(ProgressLog())``."""

    FIELDS = "query string, batch long, input_rows long, dropped_rows long, watermark string"

    def __init__(self):
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((p.name or str(p.id), p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators), dict(p.eventTime or {}).get("watermark")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.FIELDS)
