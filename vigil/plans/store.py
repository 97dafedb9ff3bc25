"""The refined layer as a stored table: partitioned by event day, read by the serving queries and lookups.

``write_refined`` is the batch writer. ``refined_table`` gives the table of an input folder, written once per
application under the shared folder (again if the input's files change), so a query reads the columns and days that it
needs instead of checking and deduplicating all readings anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from vigil.operators import sketches
from vigil.plans import refine
from vigil.session import scratch_path
from vigil.sources import fs, schemas
from vigil.streaming.medallion import utc_date
from vigil.streaming.runs import RunTable

SCHEMA = StructType(schemas.REFINED.fields).add("event_date", DateType())
_written: dict[tuple, str] = {}


def write_refined(refined: DataFrame, path: str) -> None:
    """Days are rebalanced by size: a large day gets several files, small ones are not cut up."""
    days = refined.withColumn("event_date", utc_date("event_timestamp")).hint("rebalance", "event_date")
    days.write.mode("overwrite").partitionBy("event_date").parquet(path)


def read_refined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


#: Which day a published id is on: an id opens one bucket of it, not every file of the refined table.
LOCATOR = StructType().add("event_id", "string").add("event_date", "date")


def locator(root: str, **options) -> RunTable:
    """A run table of (event_id, event_date); ``add`` it a micro-batch's published rows."""
    return RunTable(root, LOCATOR, "event_id", lambda rows: rows.distinct(), bucket_rows=1 << 14, **options)


def find_events(refined: DataFrame, where: RunTable, ids: list[str]) -> DataFrame:
    """The refined rows of the event ids: their days come from the locator, and only those days' files are opened."""
    spark = refined.sparkSession
    asked = spark.createDataFrame([(i,) for i in ids], "event_id string")
    days = where.read(spark, keys=asked).join(asked, "event_id", "left_semi").select("event_date").distinct().collect()  # a day per id at most
    return refined.where(F.col("event_date").isin([r.event_date for r in days]) & F.col("event_id").isin(list(ids)))


def stored(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder that ``write(path)`` filled for this application and these events."""
    key = (name, spark.sparkContext.applicationId, sf_dir, fs.stamp(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def refined_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_refined(spark, stored(spark, sf_dir, "refined-table", lambda path: write_refined(refine.refined(spark, sf_dir), path)))


def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects, stored: prefix scans read their input twice."""
    path = stored(spark, sf_dir, "quarantine-table", lambda path: refine.quarantined(spark, sf_dir).write.parquet(path))
    return spark.read.schema(schemas.QUARANTINE).parquet(path)


def sketch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch of the devices of each stored day."""
    days = sketches.day_sketches(refined_table(spark, sf_dir))
    return spark.read.schema(days.schema).parquet(stored(spark, sf_dir, "sketch-table", lambda path: days.write.parquet(path)))


def locator_table(spark: SparkSession, sf_dir: str) -> RunTable:
    """The locator of the stored refined table."""
    return locator(stored(spark, sf_dir, "locator", lambda path: locator(path).add(refined_table(spark, sf_dir), 0)))
