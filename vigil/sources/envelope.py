"""Topic-side data logic: payload envelope check, parsing by fixed schema, keyed topic records, topic routing.

All stateless column expressions, usable on a Kafka / file stream or on a static frame of ``(value, timestamp)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.sources import schemas

# --- fixed values that must equal the source system's -------------------------------------------------
TOPIC_PREFIX = "industrial/machines/"
TOPIC_SUFFIX = "/telemetry"
# MQTT subscription "industrial/machines/+/telemetry": '+' is exactly one (possibly empty) level.
TOPIC_PATTERN = "^industrial/machines/([^/]*)/telemetry$"
# -------------------------------------------------------------------------------------------------------


def valid_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """``accepted``: the payload is a non-empty JSON object (text, arrays, scalars, ``{}`` and junk are dropped)."""
    keys = F.json_object_keys(F.col(value).cast("string"))
    return df.withColumn("accepted", F.coalesce(F.size(keys) > 0, F.lit(False)))


def parse(df: DataFrame, value: str = "value", schema=schemas.EVENT, keep_raw: bool = True) -> DataFrame:
    """Decode the payload with the fixed event schema and flatten it; the raw text is kept (as received)."""
    raw = F.col(value).cast("string")
    extra = [c for c in df.columns if c not in (value, "key")]
    cols = [F.col(c) for c in extra] + [F.from_json(raw, schema).alias("data")]
    if keep_raw:
        cols.append(raw.alias("value"))
    parsed = df.select(*cols)
    return parsed.select(*extra, "data.*", *(["value"] if keep_raw else []))


def to_payload(df: DataFrame, exclude: tuple[str, ...] = ("arrival_seq",)) -> DataFrame:
    """Serialise each reading to its JSON text (NULL fields omitted), keeping ``exclude`` columns beside it."""
    keep = [c for c in exclude if c in df.columns]
    body = [c for c in df.columns if c not in exclude]
    return df.select(*keep, F.to_json(F.struct(*body)).alias("value"))


def keyed_records(df: DataFrame, key: str = "device_id") -> DataFrame:
    """Topic records ``(key, value)``: key = device id (NULL when missing/empty), value = JSON of the reading."""
    body = [c for c in df.columns if c != "arrival_seq"]
    return df.select(F.nullif(F.col(key), F.lit("")).alias("key"), F.to_json(F.struct(*body)).alias("value"))


def topic_for(device) -> "F.Column":
    return F.concat(F.lit(TOPIC_PREFIX), device, F.lit(TOPIC_SUFFIX))


def route(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Match a topic against the single-level wildcard subscription and extract the device level."""
    t = F.col(topic)
    return (df.withColumn("matched", t.rlike(TOPIC_PATTERN))
              .withColumn("routed_device", F.when(t.rlike(TOPIC_PATTERN), F.regexp_extract(t, TOPIC_PATTERN, 1))))
