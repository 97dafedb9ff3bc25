"""Differential reprocessing after a change of the rules: what changes is computed, not everything.

``rules_delta`` finds the event ids with a reading that the new limits judge otherwise (valid or not, flags, severity) in one narrow
pass, runs the refined flow under the old and the new limits over all readings of those ids alone (so that the first valid copy of an id
is found as in a full run), and gives the refined rows that go with weight -1 and those that come with weight +1. Rows that both runs
give cancel out. The stored refined table, tallies by device and the current status follow from the weights; the work after
the narrow pass is that of the changed ids. The readings of those ids and the weights are kept in the shared folder: what
follows from the weights reads them several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import enrich, latest
from vigil.plans import refine
from vigil.session import scratch_path

#: Columns of a refined row that a rule change can touch or that name it; stamps differ between runs.
ROW = ["arrival_seq", "event_id", "device_id", "event_timestamp", "temperature", "pressure", "vibration", "rpm", "machine_status", "anomaly_level",
       "temperature_alert", "pressure_alert", "vibration_alert"]
#: Changed rows that one task adds up.
PART_ROWS = 1 << 18
TALLIES = {"normal_count": rules.NORMAL, "warning_count": rules.WARNING, "critical_count": rules.CRITICAL}


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def changed_ids(raw: DataFrame, old: rules.Limits, new: rules.Limits) -> DataFrame:
    """Ids with a reading that ``old`` and ``new`` judge otherwise. The comparison is part of the aggregate: as a filter it would
    be pushed below the projection that makes the readings, and compute their columns anew at each mention."""
    def outcome(limits: rules.Limits):
        cols = enrich.outcome(limits)
        return F.when(rules.passes(raw.dtypes, limits), F.struct(*[c.alias(n) for n, c in cols.items()]))
    return raw.groupBy("event_id").agg(F.bool_or(~outcome(old).eqNullSafe(outcome(new))).alias("_changed")).where("_changed").select("event_id")


def rules_delta(raw: DataFrame, old: rules.Limits, new: rules.Limits) -> DataFrame:
    """The columns ROW and ``weight`` (-1 goes, +1 comes) of the refined rows that differ."""
    ids = changed_ids(raw, old, new)
    touched = _kept(raw.join(ids, raw["event_id"].eqNullSafe(ids["event_id"]), "left_semi"), "touched")
    both = [refine.refined_from(touched, limits).select(*ROW).withColumn("weight", F.lit(w)) for limits, w in ((old, -1), (new, 1))]
    # rows that cancel out share their id; a given number of parts is not made less by what the rows shrink to when compressed
    parts = max(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * touched.count() // PART_ROWS))
    weights = both[0].union(both[1]).repartition(parts, "event_id").groupBy(*ROW).agg(F.sum("weight").cast("int").alias("weight"))
    return _kept(weights.where("weight <> 0"), "delta")


def refined_after(refined: DataFrame, delta: DataFrame) -> DataFrame:
    """The refined rows (ROW) with the delta applied: rows that go are named by their arrival number."""
    gone = delta.where("weight < 0").select("arrival_seq")
    return refined.select(*ROW).join(gone, "arrival_seq", "left_anti").select(*ROW).union(delta.where("weight > 0").select(*ROW))


def tallies_after(tallies: DataFrame, delta: DataFrame) -> DataFrame:
    """Readings by device and severity with the delta's weights added; devices without readings left go."""
    change = delta.groupBy("device_id").agg(*[F.sum(F.when(F.col("anomaly_level") == level, F.col("weight")).otherwise(0)).alias(c) for c, level in TALLIES.items()])
    out = tallies.select("device_id", *TALLIES).union(change).groupBy("device_id").agg(*[F.sum(c).alias(c) for c in TALLIES])
    return out.where(" + ".join(TALLIES) + " > 0")


def status_after(status: DataFrame, refined: DataFrame, delta: DataFrame) -> DataFrame:
    """The current status (``latest.STATUS_COLUMNS``) with the delta applied: devices whose latest reading went or changed are read anew from
    their refined rows; of the others only what comes is compared."""
    lost = status.join(delta.where("weight < 0").select(F.col("arrival_seq").alias("last_arrival_seq")), "last_arrival_seq", "left_semi").select("device_id")
    anew = latest.merge_snapshot(None, refined_after(refined.join(lost, "device_id", "left_semi"), delta.join(lost, "device_id", "left_semi")))
    rest = status.join(lost, "device_id", "left_anti").select(*latest.STATUS_COLUMNS)
    return latest.merge_snapshot(rest, delta.where("weight > 0").join(lost, "device_id", "left_anti")).union(anew)
