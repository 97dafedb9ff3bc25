"""Deduplication by key.

``dedup_first`` keeps, per key, the row that arrived first. It is written as ``row_number() == 1`` so Catalyst plans a
``WindowGroupLimit`` on the map side (at most one row per key per input partition leaves the mapper), which keeps a
replay storm of one hot id from landing in one task. ``dedup_any`` is the source system's batch-local
``dropDuplicates`` (arbitrary survivor, hash aggregate with partial merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str | list[str] = "event_id", order: str = "arrival_seq",
                prefer: str | None = None) -> DataFrame:
    """Per key, the first row in ``order``; with ``prefer`` (a boolean column) the first row where it is true wins
    over any earlier row where it is false."""
    keys = [key] if isinstance(key, str) else list(key)
    sort = ([F.col(prefer).desc()] if prefer else []) + [F.col(order).asc()]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_any(df: DataFrame, key: str | list[str] = "event_id") -> DataFrame:
    return df.dropDuplicates([key] if isinstance(key, str) else list(key))


def dedup_stream(df: DataFrame, key: str = "event_id", event_time: str = "event_ts",
                 delay: str | None = None) -> DataFrame:
    """Cross-micro-batch dedup of a streaming frame. Without ``delay`` it is exact however the input is cut: the
    state store keeps every key (RocksDB, on disk, written incrementally), and no history is read. With ``delay`` the
    state is bounded by the watermark, and rows later than that are dropped by Spark, duplicates or not."""
    if delay is None:
        return df.dropDuplicates([key])
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def anti_seen(batch: DataFrame, seen_keys: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop rows whose key was already published (exact "ever seen" check via a left-anti join)."""
    return batch.join(seen_keys.select(key), on=key, how="left_anti")
