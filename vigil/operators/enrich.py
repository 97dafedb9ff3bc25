"""Refined-layer enrichment: parsed event time, alert flags, severity, renamed state, stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.sources.schemas import REFINED_COLUMNS


def outcome(limits: rules.Limits = rules.LIMITS) -> dict:
    """The columns of a refined row that depend on the limits."""
    return {**rules.alert_flags(limits), "anomaly_level": rules.severity(limits)}


def enrich(df: DataFrame, limits: rules.Limits = rules.LIMITS) -> DataFrame:
    text_ts = dict(df.dtypes)["event_timestamp"] == "string"
    cols = {"event_timestamp": F.expr(rules.parsed_time_sql("event_timestamp") if text_ts
                                      else "CAST(event_timestamp AS TIMESTAMP)")}
    cols.update(outcome(limits))
    cols["machine_status"] = F.expr("status")
    if "ingestion_timestamp" not in df.columns:
        cols["ingestion_timestamp"] = F.expr("current_timestamp()")
    cols["processing_timestamp"] = F.expr("current_timestamp()")
    return df.withColumns(cols).drop("status")


def project_refined(df: DataFrame, keep_arrival: bool = True) -> DataFrame:
    extra = ["arrival_seq"] if keep_arrival and "arrival_seq" in df.columns else []
    return df.select(*extra, *REFINED_COLUMNS)
