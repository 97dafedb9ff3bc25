"""The refined table clustered for reads by device, time or severity, with a zone of each file.

Inside an event day rows follow a Z-order curve over device and time of day: the bits of both are interleaved, so a file holds
a few devices for a part of the day, and a read by either opens a part of the files, by both a few. ``_zones`` beside the
days lists for every file its least and greatest device and time and the severities in it; ``find`` reads that small
table first and opens only files whose zones fit. File sizes follow ``file_rows`` alone: a device or an hour that holds a third
of all rows is split by the curve, then by device and time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.plans.store import SCHEMA, read_refined
from vigil.session import scratch_path
from vigil.streaming.medallion import utc_date

#: Bits of the curve a dimension: so many ranges of devices, and parts of a day.
BITS = 6
FILE_ROWS = 1 << 21
#: Up to so many files are named one by one; a read that needs more opens the days as a whole.
NAMED = 10_000

ZONES = "file string, event_date date, device_least string, device_most string, time_least timestamp, time_most timestamp, levels array<string>, records long"


def interleaved(*dimensions: str, bits: int = BITS) -> Column:
    """The place on the Z-order curve of columns with numbers of ``bits`` bits."""
    n = len(dimensions)
    return F.expr(" + ".join(f"shiftleft(CAST(shiftright({d}, {i}) & 1 AS BIGINT), {n * i + k})" for i in range(bits) for k, d in enumerate(dimensions)))


def device_ranges(refined: DataFrame) -> DataFrame:
    """(device_id, range): devices in 2^BITS ranges by order of their names, about equally many in each."""
    devices = refined.select("device_id").distinct()
    path = scratch_path(refined.sparkSession, "device-ranges")
    devices.repartitionByRange(1 << BITS, "device_id").select("device_id", F.spark_partition_id().alias("range")).write.parquet(path)
    return refined.sparkSession.read.schema("device_id string, range int").parquet(path)


def write_clustered(refined: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """``refined`` should be a stored table: it is read for its size, its devices, the curve's cuts and the rows."""
    spark = refined.sparkSession
    files = max(1, -(-refined.count() // file_rows))
    part = f"CAST(floor((unix_micros(event_timestamp) - unix_micros(CAST(event_date AS TIMESTAMP))) * {1 << BITS} / 86400000000D) AS INT)"
    rows = refined.select(*[c for c in SCHEMA.names if c != "event_date"]).withColumn("event_date", utc_date("event_timestamp"))
    placed = rows.join(device_ranges(refined), "device_id", "left").withColumn("_part", F.expr(f"coalesce({part}, 0) & {(1 << BITS) - 1}"))
    order = ["event_date", "_z", "device_id", "event_timestamp"]
    dealt = placed.withColumn("_z", interleaved("coalesce(range, 0)", "_part")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.select(*SCHEMA.names).write.mode("overwrite").partitionBy("event_date").parquet(path)
    zones = read_refined(spark, path).select("*", F.col("_metadata.file_path").alias("file")).groupBy("file", "event_date").agg(
        F.min("device_id").alias("device_least"), F.max("device_id").alias("device_most"), F.min("event_timestamp").alias("time_least"),
        F.max("event_timestamp").alias("time_most"), F.collect_set("anomaly_level").alias("levels"), F.count(F.lit(1)).alias("records"))
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}/_zones")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ZONES).parquet(f"{path}/_zones")


def find(spark: SparkSession, path: str, device: str | None = None, since: dt.datetime | None = None, until: dt.datetime | None = None,
         level: str | None = None) -> DataFrame:
    """Rows of a device, from ``since`` to ``until`` (both included), of a severity; whatever is None does not count. Only files
    whose zones fit are opened."""
    zone, row = F.lit(True), F.lit(True)
    if device is not None:
        zone &= (F.col("device_least") <= device) & (F.col("device_most") >= device)
        row &= F.col("device_id") == device
    if since is not None:
        zone &= F.col("time_most") >= F.lit(since)
        row &= F.col("event_timestamp") >= F.lit(since)
    if until is not None:
        zone &= F.col("time_least") <= F.lit(until)
        row &= F.col("event_timestamp") <= F.lit(until)
    if level is not None:
        zone &= F.array_contains("levels", level)
        row &= F.col("anomaly_level") == level
    named = [r.file for r in read_zones(spark, path).where(zone).select("file").limit(NAMED + 1).collect()]
    if not named:
        return spark.createDataFrame([], SCHEMA)
    table = read_refined(spark, path) if len(named) > NAMED else spark.read.schema(SCHEMA).option("basePath", path).parquet(*named)
    return table.where(row)
