"""Distinct devices from mergeable sketches: one HyperLogLog sketch per day, unions over any range of days.

``day_sketches`` aggregates once, when a day is written (partial aggregation: a hot device or day is merged on the mappers); the
sketches are a few KB a day whatever the number of readings. Counts of a range of days are unions of its sketches, so no
reading is read again, and late readings of a day are a second sketch of that day. The relative standard error is about
1.04 / sqrt(2^lg_k); small counts (below 2^lg_k / 8 or so) are exact but for hash collisions. ``exact_devices`` is the exact count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def day_sketches(refined: DataFrame, day: str = "event_date", key: str = "device_id", lg_k: int = LG_K) -> DataFrame:
    """(day, events, sketch), readings without a device counted as events only."""
    return refined.groupBy(day).agg(F.count(F.lit(1)).alias("events"), F.hll_sketch_agg(key, lg_k).alias("sketch"))


def devices(sketches: DataFrame, days: int = 1, day: str = "event_date") -> DataFrame:
    """(day, events, devices): for each day that has any, over the last ``days`` days, itself included."""
    reach = sketches.select(F.explode(F.expr(f"sequence({day}, date_add({day}, {int(days) - 1}))")).alias("_to"), "events", "sketch")
    present = sketches.select(F.col(day).alias("_day")).distinct()
    g = reach.join(present, reach["_to"].eqNullSafe(present["_day"]), "left_semi").groupBy(F.col("_to").alias(day))
    return g.agg(F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("devices"))


def exact_devices(refined: DataFrame, day: str = "event_date", key: str = "device_id") -> DataFrame:
    """(day, events, devices) from the readings themselves."""
    return refined.groupBy(day).agg(F.count(F.lit(1)).alias("events"), F.count_distinct(key).alias("devices"))
