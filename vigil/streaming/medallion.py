"""Bronze and refined streaming queries.

Bronze: parsed readings appended to Parquet with a checkpoint (exactly-once file sink).

Refined: one ``foreachBatch`` writer drives every sink from a single persisted, checked micro-batch:

* quarantine   -> ``<root>/quarantine/batch_id=<n>``   (overwrite of its own folder: a replayed batch replaces itself)
* refined      -> ``<root>/refined/batch_id=<n>/event_date=<d>``
                                                       keep-first dedup inside the batch, then (``exact_dedup``)
                                                       a left-anti join against ids published by earlier batches
                                                       (``<root>/ids/batch_id < n``: the id column alone, never the
                                                       refined history itself)
                                                       or, with ``index``, against the buckets of a run table that may
                                                       hold the batch's ids (``runs.id_index``): what a batch reads then
                                                       follows the batch
* current state-> ``<root>/current_status/v=<n>``      keyed merge of the previous version and the new rows;
                                                       readers take the highest version. With ``status`` a run table
                                                       (``status_table``): a batch writes its own devices, readers merge
* counts       -> ``observe`` metrics (raw / valid / invalid) without extra jobs

Errors are not swallowed: a failing batch fails the query and is retried from the checkpoint; since every write
is keyed by ``batch_id`` the retry is idempotent. A query with another checkpoint numbers its batches from 0 again,
so a root belongs to the query that wrote it first; any other fails instead of replacing its batches.

A batch may publish nothing (all invalid, or all published before): the sinks behind the refined layer are not called
then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.functions import rules
from vigil.operators import dedup, enrich, latest, quality
from vigil.sources import fs, schemas
from vigil.streaming.runs import RunTable

#: Time between micro-batches of a continuous run.
INTERVAL = "5 seconds"


def triggered(w, available_now: bool, interval: str = INTERVAL):
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)


def start_bronze(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 name: str | None = None, interval: str = INTERVAL) -> StreamingQuery:
    """``stream``: topic-shaped frame with ``value`` (JSON text) -> parsed readings appended to Parquet."""
    from vigil.sources import envelope
    parsed = envelope.parse(stream).withColumn("ingestion_timestamp", F.current_timestamp())
    w = (parsed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
               .option("path", path))
    if name:
        w = w.queryName(name)
    w = triggered(w, available_now, interval)
    return w.start()


def utc_date(ts: str):
    """The UTC calendar day of a timestamp, whatever the session's zone."""
    return F.expr(f"to_date(to_utc_timestamp({ts}, current_timezone()))")


class RefinedWriter:
    """``foreachBatch`` callable: checked batch -> quarantine, refined, current-status snapshot."""

    def __init__(self, root: str, limits: rules.Limits = rules.LIMITS, exact_dedup: bool = True,
                 payload_col: str | None = "value", keep_versions: int = 3, downstream=(), index: RunTable | None = None, status: RunTable | None = None):
        self.root = root.rstrip("/")
        self.limits = limits
        self.exact_dedup = exact_dedup
        self.payload_col = payload_col
        self.keep_versions = keep_versions
        self.last_counts: dict = {}
        self.index, self.status = index, status
        # callables (refined_rows_of_this_batch, batch_id) run after the refined write -- e.g. a MaintenanceWriter:
        # they see exactly this batch's published rows, in the same micro-batch, so arrival order is kept
        self.downstream = list(downstream)

    @property
    def refined_path(self) -> str:
        return f"{self.root}/refined"

    @property
    def ids_path(self) -> str:
        return f"{self.root}/ids"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def status_path(self) -> str:
        return f"{self.root}/current_status"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():          # nothing arrived: write nothing (reads at most one row)
            return
        self._own(spark)
        obs = Observation(f"dq_{batch_id}")
        checked = quality.check(batch, self.limits).observe(
            obs, F.count(F.lit(1)).alias("raw_count"), F.count_if(F.col("is_valid")).alias("valid_count"),
            F.count_if(~F.col("is_valid")).alias("invalid_count")).persist()
        kept = [checked]
        try:
            valid, invalid = quality.split(checked)
            # the payload as received (raw topic text) when the batch carries it, else the row as JSON
            payload = self.payload_col if self.payload_col and self.payload_col in batch.columns else None
            (quality.quarantine(invalid, payload).write.mode("overwrite")
                    .parquet(f"{self.quarantine_path}/batch_id={batch_id}"))

            firsts = dedup.dedup_first(valid, "event_id", "arrival_seq" if "arrival_seq" in batch.columns
                                       else "event_timestamp")
            if self.index:
                firsts = firsts.persist()
                kept.append(firsts)
                firsts = dedup.anti_seen(firsts, self.index.read(spark, before=batch_id, keys=firsts))
            elif self.exact_dedup and fs.has_data(spark, self.ids_path):
                seen = spark.read.schema("event_id string, batch_id bigint").parquet(self.ids_path)
                firsts = dedup.anti_seen(firsts, seen.filter(F.col("batch_id") < batch_id))
            refined = enrich.project_refined(enrich.enrich(firsts, self.limits))
            out = f"{self.refined_path}/batch_id={batch_id}"
            # days are rebalanced by size, else every task has a file of every day, and readers open them one by one
            (refined.withColumn("event_date", utc_date("event_timestamp")).hint("rebalance", "event_date")
                    .write.mode("overwrite").partitionBy("event_date").parquet(out))

            # read back by the known columns: a batch without publishable rows leaves no file to infer them from
            published = spark.read.schema(self._schema(refined)).parquet(out)
            if not published.isEmpty():
                if self.index:
                    self.index.add(published.select("event_id"), batch_id)
                else:
                    published.select("event_id").write.mode("overwrite").parquet(f"{self.ids_path}/batch_id={batch_id}")
                if self.status:
                    self.status.add(latest.merge_snapshot(None, published), batch_id)
                else:
                    self._merge_status(spark, published, batch_id)
                for sink in self.downstream:
                    sink(published, batch_id)
            self.last_counts = {"batch_id": batch_id, **obs.get}
        finally:
            for frame in kept:
                frame.unpersist()

    @staticmethod
    def _schema(refined: DataFrame):
        """``schemas.REFINED``, without the arrival number where the batch has none."""
        return schemas.REFINED if "arrival_seq" in refined.columns else type(schemas.REFINED)(schemas.REFINED.fields[1:])

    def _own(self, spark: SparkSession) -> None:
        """The root's query: the id that its checkpoint keeps (none when the writer is called directly)."""
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query:
            others = [x for x in fs.names(spark, f"{self.root}/_query") if x != query]
            if others:
                raise RuntimeError(f"{self.root} holds batches of query {others[0]}; its checkpoint is needed, or another root")
            fs.mkdirs(spark, f"{self.root}/_query/{query}")

    def _merge_status(self, spark: SparkSession, new_rows: DataFrame, batch_id: int) -> None:
        versions = [v for v in fs.partition_values(spark, self.status_path, "v") if v < batch_id]
        old = spark.read.parquet(f"{self.status_path}/v={versions[-1]}") if versions else None
        merged = latest.merge_snapshot(old, new_rows)
        merged.write.mode("overwrite").parquet(f"{self.status_path}/v={batch_id}")
        for v in versions[:-max(self.keep_versions - 1, 1)]:
            fs.delete(spark, f"{self.status_path}/v={v}")


def start_refined(stream: DataFrame, writer: RefinedWriter, checkpoint: str, available_now: bool = True,
                  name: str | None = None, interval: str = INTERVAL) -> StreamingQuery:
    observed = stream.observe("ingest", F.count(F.lit(1)).alias("raw_count"))
    w = observed.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = triggered(w, available_now, interval)
    return w.start()


def status_table(root: str, **options) -> RunTable:
    """The current status as runs of the devices that each micro-batch had, the latest reading of a device counting."""
    return RunTable(root, schemas.STATUS, "device_id", latest.merge_status, **options)


def read_current_status(spark: SparkSession, status_path: str) -> DataFrame | None:
    versions = fs.partition_values(spark, status_path, "v")
    return spark.read.parquet(f"{status_path}/v={versions[-1]}") if versions else None


def start_stream_dedup(stream: DataFrame, path: str, checkpoint: str, delay: str | None = None,
                       available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    """Cross-batch dedup of valid readings. Exact by default; with ``delay`` state expires with the watermark and
    later readings are lost (see ``dedup.dedup_stream``)."""
    valid, _ = quality.split(quality.check(stream))
    timed = valid.withColumn("event_ts", rules.parsed_time(F.col("event_timestamp")))
    out = dedup.dedup_stream(timed, "event_id", "event_ts", delay).drop("failed_codes", "is_valid", "error_reason")
    w = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .option("path", path))
    return triggered(w, available_now, interval).start()
