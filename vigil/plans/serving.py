"""Views for users who query the serving tables with SQL.

Two base views (the refined history and the current status) and one per serving query, made by the DataFrame operators
in ``operators.analytics``: ``SELECT * FROM avg_by_device`` plans the same aggregate, and filters on a view reach the
stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil.operators import analytics

MEASUREMENTS = "refined_machine_measurements"
CURRENT_STATUS = "refined_machine_current_status"

#: view -> (base view, operator)
VIEWS = {
    "critical_now": (CURRENT_STATUS, analytics.critical_now),
    "top_temperature": (MEASUREMENTS, lambda df: analytics.top_by(df, "temperature")),
    "top_vibration": (MEASUREMENTS, lambda df: analytics.top_by(df, "vibration")),
    "total_events": (MEASUREMENTS, analytics.total_events),
    "events_by_status": (MEASUREMENTS, lambda df: analytics.count_by(df, "machine_status")),
    "events_by_anomaly": (MEASUREMENTS, lambda df: analytics.count_by(df, "anomaly_level")),
    "avg_by_device": (MEASUREMENTS, analytics.avg_by_device),
    "alerts_by_device": (MEASUREMENTS, analytics.alerts_by_device),
    "anomaly_by_device": (MEASUREMENTS, analytics.anomaly_by_device),
}


def register_views(refined: DataFrame, status: DataFrame) -> None:
    base = {MEASUREMENTS: refined, CURRENT_STATUS: status}
    for name, df in base.items():
        df.createOrReplaceTempView(name)
    for name, (of, operator) in VIEWS.items():
        operator(base[of]).createOrReplaceTempView(name)
