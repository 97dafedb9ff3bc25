"""Streaming sources.

``kafka_topic`` is the production reader (needs the Kafka connector on the classpath; nothing here loads it).
``events_replay`` is the offline stand-in: a file stream over the ``events`` Parquet table (or a folder of its
pieces), one file per trigger, producing the same readings as the topic would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources import envelope
from vigil.sources import telemetry as tel


def kafka_topic(spark: SparkSession, servers: str, topic: str = "iot-machine-events",
                starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                fail_on_data_loss: bool = True) -> DataFrame:
    """``(key, value, topic, partition, offset, timestamp)`` stream from a Kafka topic. Records that expired before
    they were read fail the query unless ``fail_on_data_loss`` is turned off."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def kafka_readings(raw: DataFrame) -> DataFrame:
    """Topic records -> parsed readings with the broker timestamp, raw text kept for quarantine.

    ``arrival_seq`` is the partition offset: records are keyed by device, so a device's readings (and any re-sent
    copy of one) share a partition and the offset orders them as they arrived -- what the per-device scans and the
    keep-first dedup need. ``kafka_partition`` is kept beside it."""
    parsed = envelope.parse(raw.select(F.col("offset").cast("bigint").alias("arrival_seq"),
                                       F.col("partition").alias("kafka_partition"),
                                       F.col("value").cast("string").alias("value"),
                                       F.col("timestamp").alias("kafka_timestamp")))
    return parsed.withColumn("ingestion_timestamp", F.current_timestamp())


def events_replay(spark: SparkSession, source: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Stream the ``events`` table: ``source`` is an sf folder (reads its ``events.parquet``) or a folder of parts."""
    path = source.rstrip("/")
    if not path.endswith(".parquet"):
        single = f"{path}/events.parquet"
        from vigil.sources import fs
        if fs.exists(spark, single):
            path = f"{path}/event[s].parquet"   # a file stream needs a directory or a glob, not a file
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
                 .parquet(path))


def telemetry_replay(spark: SparkSession, source: str, max_files_per_trigger: int = 1) -> DataFrame:
    return tel.telemetry_from_events(events_replay(spark, source, max_files_per_trigger))


def topic_replay(spark: SparkSession, source: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The replay shaped like a topic: ``(arrival_seq, value, kafka_timestamp)`` with JSON payloads."""
    t = telemetry_replay(spark, source, max_files_per_trigger)
    return envelope.to_payload(t).withColumn("kafka_timestamp", F.current_timestamp())


def message_replay(spark: SparkSession, source: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Messages with fields that the event schema does not name, parsed, the text kept in ``value``."""
    return envelope.parse(tel.messages_from_events(events_replay(spark, source, max_files_per_trigger)))
