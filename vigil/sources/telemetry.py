"""Telemetry input derived from the ``events`` table.

The given tables contain no machine readings, so the telemetry stream is a deterministic projection of ``events``
(FIXTURES.md §3): one reading per event, with duplicate ids, blank devices, missing / late timestamps, negative and
missing metrics and bad states injected by fixed rules on the event id. Everything is narrow (no shuffle); only the
columns used are read from Parquet.

``event_timestamp`` is ISO-8601 text with microseconds and ``Z`` as on the wire; ``arrival_seq`` is the arrival order.

Expressions are written as SQL text (``selectExpr``): Catalyst plans them exactly like Column-builder code, but each
costs one call into the JVM instead of one per sub-expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TELEMETRY_COLUMNS = ["arrival_seq", "event_id", "device_id", "event_timestamp", "temperature", "pressure",
                     "vibration", "rpm", "status"]
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_EVENT_TS = ("CASE WHEN event_id % 107 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) "
             "WHEN event_id % 50 = 7 THEN ts - INTERVAL '12' HOUR ELSE ts END")

# One reading per event (FIXTURES.md §3); device ids are zero-padded to at least four digits, never truncated.
PROJECTION = [
    "event_id AS arrival_seq",
    "concat('evt-', CAST(CASE WHEN event_id % 40 = 39 THEN event_id - 1 ELSE event_id END AS STRING)) AS event_id",
    "CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('MTR-', CASE WHEN user_id < 1000 "
    "THEN lpad(CAST(user_id AS STRING), 4, '0') ELSE CAST(user_id AS STRING) END) END AS device_id",
    f"date_format({_EVENT_TS}, \"{ISO_FORMAT}\") AS event_timestamp",
    "value AS temperature",
    "CASE WHEN event_id % 83 = 0 THEN -1.0D "
    "ELSE CAST(CAST(get_json_object(props, '$.k') AS INT) * 8 AS DOUBLE) / 100.0D END AS pressure",
    "CASE WHEN event_id % 79 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 23 = 0 THEN 16.0D + CAST(event_id % 9 AS DOUBLE) "
    "ELSE CAST((event_id * 37) % 700 AS DOUBLE) / 100.0D END AS vibration",
    "CAST(CASE WHEN event_id % 89 = 0 THEN -1 ELSE 1400 + (event_id * 13) % 400 END AS INT) AS rpm",
    "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 103 = 0 THEN 'EXPLODED' "
    "WHEN event_type = 'error' AND event_id % 20 = 0 THEN 'FAILURE' WHEN event_type = 'error' THEN 'MAINTENANCE' "
    "WHEN event_type = 'signup' THEN 'STOPPED' ELSE 'RUNNING' END AS status",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Project ``events`` into raw telemetry readings. Works on static and streaming frames."""
    return events.selectExpr(*PROJECTION)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(table(spark, sf_dir, "events"))


#: A message of a newer device: the reading, a nested ``machine`` and for one event in 31 a ``firmware``, fields that the event
#: schema does not name; the message of one event in 211 breaks off before its end.
MESSAGE = "CASE WHEN event_id % 211 = 0 THEN left(_whole, length(_whole) - 1) ELSE _whole END"


def messages_from_events(events: DataFrame) -> DataFrame:
    """``(arrival_seq, value)``: the readings as messages with fields that the schema does not name. Static or streaming."""
    names = [c for c in TELEMETRY_COLUMNS if c != "arrival_seq"]
    shaped = events.selectExpr("event_id AS _id", "event_type AS _kind", "CAST(get_json_object(props, '$.k') AS INT) AS _k", *PROJECTION)
    whole = (f"to_json(struct({', '.join(names)}, struct(_kind AS kind, _k AS k) AS machine,"
             " CASE WHEN _id % 31 = 0 THEN concat('v', CAST(_id % 5 AS STRING)) END AS firmware))")
    return shaped.selectExpr("arrival_seq", "_id AS event_id", f"{whole} AS _whole").selectExpr("arrival_seq", f"{MESSAGE} AS value")
