"""The analytic queries over the refined history and the current-status table, plus point lookups.

All aggregates here are keyed ``groupBy`` aggregates, so Spark plans partial (map-side) + final hash aggregation:
a hot device is pre-aggregated on every mapper before the shuffle. Top-k uses ``orderBy(...).limit(k)`` which
becomes ``TakeOrderedAndProject`` (k rows per partition, never a global sort). Every ordering carries a unique
tie-break so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import exact


def critical_now(status: DataFrame) -> DataFrame:
    """Q1: devices whose latest reading is CRITICAL, newest first."""
    return (status.filter(F.col("anomaly_level") == "CRITICAL")
                  .select("device_id", "last_event_timestamp", "temperature", "pressure", "vibration",
                          "anomaly_level")
                  .orderBy(F.col("last_event_timestamp").desc_nulls_first(), "device_id"))


def top_by(refined: DataFrame, metric: str, k: int = 5) -> DataFrame:
    """Q2/Q3: the k highest readings of ``metric`` (tie-break on event id)."""
    return (refined.select("device_id", "event_id", "event_timestamp", metric, "anomaly_level")
                   .orderBy(F.col(metric).desc_nulls_first(), F.col("event_id").asc()).limit(k))


def total_events(refined: DataFrame) -> DataFrame:
    """Q4."""
    return refined.agg(F.count(F.lit(1)).alias("total_processed_events"))


def count_by(refined: DataFrame, column: str) -> DataFrame:
    """Q5/Q6: row count per value, most frequent first."""
    return (refined.groupBy(column).agg(F.count(F.lit(1)).alias("event_count"))
                   .orderBy(F.col("event_count").desc(), F.col(column)))


def avg_by_device(refined: DataFrame) -> DataFrame:
    """Q7: exact HALF_UP averages to 2 dp + count per device."""
    sums = refined.groupBy("device_id").agg(
        exact.sum_hundredths(F.col("temperature")).alias("_st"),
        exact.sum_hundredths(F.col("pressure")).alias("_sp"),
        exact.sum_hundredths(F.col("vibration")).alias("_sv"),
        F.count(F.lit(1)).alias("total_measurements"))
    return (sums.select("device_id",
                        exact.half_up_avg2("_st", "total_measurements").alias("avg_temperature"),
                        exact.half_up_avg2("_sp", "total_measurements").alias("avg_pressure"),
                        exact.half_up_avg2("_sv", "total_measurements").alias("avg_vibration"),
                        "total_measurements")
                .orderBy("device_id"))


def alerts_by_device(refined: DataFrame) -> DataFrame:
    """Q8: per-device alert tallies, most alerts first."""
    any_alert = F.col("temperature_alert") | F.col("pressure_alert") | F.col("vibration_alert")
    return (refined.groupBy("device_id").agg(
                F.count_if(F.col("temperature_alert")).alias("temp_alerts"),
                F.count_if(F.col("pressure_alert")).alias("press_alerts"),
                F.count_if(F.col("vibration_alert")).alias("vib_alerts"),
                F.count_if(any_alert).alias("total_alerts"))
            .orderBy(F.col("total_alerts").desc(), "device_id"))


def anomaly_by_device(refined: DataFrame) -> DataFrame:
    """Q9: severity pivot per device (fixed pivot values, so no extra job to discover them)."""
    lvl = F.col("anomaly_level")
    return (refined.groupBy("device_id").agg(
                F.count_if(lvl == "NORMAL").alias("normal_count"),
                F.count_if(lvl == "WARNING").alias("warning_count"),
                F.count_if(lvl == "CRITICAL").alias("critical_count"))
            .orderBy("device_id"))


def rejected_total(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(F.count(F.lit(1)).alias("rejected_events"))


def lookup(df: DataFrame, columns: list[str] | None = None, **equalities) -> DataFrame:
    """Point lookup by equalities; the filter is pushed into the Parquet scan when ``df`` is a scan."""
    cond = F.lit(True)
    for c, v in equalities.items():
        cond = cond & (F.col(c) == F.lit(v))
    out = df.filter(cond)
    return out.select(*columns) if columns else out
