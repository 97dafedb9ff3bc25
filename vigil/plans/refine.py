"""Batch form of the medallion flow: raw telemetry -> checked -> (quarantine | deduplicated, enriched refined).

The same pure functions drive the streaming ``foreachBatch`` writer; here they run over whole tables
(backfill / reprocessing of stored bronze or archive data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import dedup, enrich, quality
from vigil.sources import telemetry as tel


def checked(raw: DataFrame, limits: rules.Limits = rules.LIMITS) -> DataFrame:
    return quality.check(raw, limits)


def refined_from(raw: DataFrame, limits: rules.Limits = rules.LIMITS) -> DataFrame:
    """Keep-first dedup among valid readings, then enrichment.

    The dedup window runs over all checked rows ordered by (valid first, arrival) and the validity filter is applied
    after it: the filter then stays above the window instead of being pushed (with the whole projection inlined)
    into the scan, and the first *valid* copy of an id wins exactly as if invalid rows had been removed first."""
    first = dedup.dedup_first(checked(raw, limits), "event_id", "arrival_seq", prefer="is_valid")
    return enrich.project_refined(enrich.enrich(first.filter(F.col("is_valid")), limits))


def quarantine_from(raw: DataFrame, limits: rules.Limits = rules.LIMITS, payload_col: str | None = None) -> DataFrame:
    _, invalid = quality.split(checked(raw, limits))
    return quality.quarantine(invalid, payload_col)


def refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined_from(tel.telemetry(spark, sf_dir))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_from(tel.telemetry(spark, sf_dir))
