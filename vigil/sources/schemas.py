"""Fixed schemas (no inference on the stream)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

# --- fixed values: field names, types and order of the wire format ---------------------------------------------------
# Telemetry event as it arrives on the topic.
EVENT = StructType([
    StructField("event_id", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("event_timestamp", StringType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("pressure", DoubleType(), True),
    StructField("vibration", DoubleType(), True),
    StructField("rpm", IntegerType(), True),
    StructField("status", StringType(), True),
    StructField("machine_type", StringType(), True),
    StructField("location", StringType(), True),
])

# -----------------------------------------------------------------------------------------------------------------

# Telemetry replay rows as produced by ``sources.telemetry`` (arrival order first).
TELEMETRY = StructType([StructField("arrival_seq", LongType(), True)] + [
    f for f in EVENT.fields if f.name not in ("machine_type", "location")])

ALERT = StructType([
    StructField("arrival_seq", LongType(), True),
    StructField("alert_id", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("event_id", StringType(), True),
    StructField("severity", StringType(), True),
    StructField("reasons", ArrayType(StringType()), True),
    StructField("metrics", StructType([
        StructField("temperature", DoubleType(), True),
        StructField("pressure", DoubleType(), True),
        StructField("vibration", DoubleType(), True),
        StructField("status", StringType(), True),
    ]), True),
    StructField("event_timestamp", StringType(), True),
    StructField("alert_timestamp", TimestampType(), True),
])

ARCHIVE = StructType([
    StructField("_ingested_at", TimestampType(), True),
    StructField("_source_topic", StringType(), True),
    StructField("raw_text", StringType(), True),
    StructField("raw_payload", TELEMETRY, True),
    StructField("year", StringType(), True),
    StructField("month", StringType(), True),
    StructField("day", StringType(), True),
])

QUARANTINE = StructType([
    StructField("arrival_seq", LongType(), True),
    StructField("event_id", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("error_reason", StringType(), True),
    StructField("original_payload", StringType(), True),
    StructField("quarantine_timestamp", TimestampType(), True),
])

# --- fixed values: columns of the serving table, in its order ----------------------------------------------------
REFINED_COLUMNS = ["event_id", "device_id", "event_timestamp", "ingestion_timestamp", "temperature", "pressure",
                   "vibration", "rpm", "machine_status", "anomaly_level", "temperature_alert", "pressure_alert",
                   "vibration_alert", "processing_timestamp"]
# -----------------------------------------------------------------------------------------------------------------

# The refined table, as written and read back: arrival order first, types as on the wire but for times and flags.
REFINED = StructType([StructField("arrival_seq", LongType(), True)] + [
    StructField(c, TimestampType() if c.endswith("_timestamp") else BooleanType() if c.endswith("_alert")
                else EVENT[c].dataType if c in EVENT.names else StringType(), True) for c in REFINED_COLUMNS])

# The current status of a device: its latest reading, and the arrival number that decides between equal times.
STATUS = StructType([
    StructField("device_id", StringType(), True),
    StructField("last_event_id", StringType(), True),
    StructField("last_event_timestamp", TimestampType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("pressure", DoubleType(), True),
    StructField("vibration", DoubleType(), True),
    StructField("rpm", IntegerType(), True),
    StructField("machine_status", StringType(), True),
    StructField("anomaly_level", StringType(), True),
    StructField("last_arrival_seq", LongType(), True),
])

# --- fixed values: columns that the serving table requires -------------------------------------------------------
REFINED_NOT_NULL = ["event_id", "device_id", "event_timestamp", "ingestion_timestamp", "temperature", "pressure",
                    "vibration", "rpm", "machine_status", "anomaly_level", "temperature_alert", "pressure_alert",
                    "vibration_alert"]
