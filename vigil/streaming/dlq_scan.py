"""Rejects stored as JSON lines in nested folders, counted as files arrive, each file once.

Spark's file source remembers the paths that it has read. A file that is moved or renamed (sorted into another folder, say)
has a new path, and so has a copy; ``DlqScan`` keeps a ledger of files by content and counts a file only if no file of the same
records was counted before. Records hold their arrival number and time, so files of equal records are copies. The ledger
and the counts are run tables: a micro-batch reads and writes what it has, and a replayed one replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil.operators import consumers
from vigil.sources import schemas
from vigil.streaming.medallion import INTERVAL, triggered
from vigil.streaming.runs import RunTable

FILE = "_file"
LEDGER = StructType().add("content", "string").add("file", "string").add("records", "long")
REASONS = StructType().add("error_reason", "string").add("n", "long")


def files(spark: SparkSession, path: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """The records of all files below ``path`` as a stream, with the file of each; old files count as well as new ones."""
    r = (spark.readStream.schema(schemas.QUARANTINE).option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", str(max_files_per_trigger)).option("maxFileAge", "36500d"))
    return r.json(path).select("*", F.col("_metadata.file_path").alias(FILE))


def contents(records: DataFrame) -> DataFrame:
    """Each file with a key of its records, whatever their order: their number and two sums of hashes."""
    columns = [c for c in records.columns if c != FILE]
    sums = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")) for salt in (1, 2)]
    return records.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("records"), F.concat_ws(":", F.count(F.lit(1)), *sums).alias("content"))


class DlqScan:
    """``foreachBatch``: counts by reason (``reasons``) and the files counted (``ledger``)."""

    def __init__(self, root: str):
        root = root.rstrip("/")
        self.ledger = RunTable(f"{root}/ledger", LEDGER, "content", lambda rows: rows.groupBy("content").agg(F.min("file").alias("file"), F.max("records").alias("records")))
        self.reasons = RunTable(f"{root}/reasons", REASONS, "error_reason", lambda rows: rows.groupBy("error_reason").agg(F.sum("n").alias("n")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = contents(batch).groupBy("content").agg(F.min("file").alias("file"), F.max("records").alias("records")).persist()
        try:
            counted = self.ledger.read(spark, before=batch_id, keys=found).select("content")
            new = found.join(counted, "content", "left_anti").persist()
            mine = batch.join(new.select(F.col("file").alias(FILE)), FILE, "left_semi").drop(FILE)
            self.reasons.add(consumers.dlq_by_reason(mine), batch_id)
            self.ledger.add(new, batch_id)
            new.unpersist()
        finally:
            found.unpersist()


def start_dlq_scan(records: DataFrame, scan: DlqScan, checkpoint: str, available_now: bool = True, interval: str = INTERVAL) -> StreamingQuery:
    return triggered(records.writeStream.foreachBatch(scan).option("checkpointLocation", checkpoint), available_now, interval).start()
