"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> DuckDB SQL``.

Every query reads the whole given tables (``events`` through the telemetry projection) and returns a flat frame whose
column names equal the oracle's. Timestamps are returned as ``timestamp_ntz`` (UTC wall time) to compare with
DuckDB's naive timestamps; nested values (arrays, maps, structs) are returned flattened or joined.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import rules, text
from vigil.operators import analytics, consumers, dedup, latest, quality, sketches, windows
from vigil.plans import clustered, oracle, refine, reprocess, serving, store, stream_runs
from vigil.sources import envelope, schemas
from vigil.sources import telemetry as tel
from vigil.streaming import archive as archives
from vigil.streaming import wear

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def wrap(fn):
        def run(spark, sf_dir):
            # day boundaries, ISO parsing and the naive timestamps returned are UTC (as the source system pins it)
            if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return ntz(fn(spark, sf_dir))
        QUERIES[name] = run
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return wrap


def ntz(df: DataFrame) -> DataFrame:
    """Cast zone-aware timestamps to naive UTC wall time for comparison with the oracle."""
    cols = [F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes]
    return df.select(*cols)


# --- refined layer ---------------------------------------------------------------------------------------------

REFINED_ORACLE_COLS = ("arrival_seq, event_id, device_id, event_timestamp, temperature, pressure, vibration, rpm, "
                       "machine_status, anomaly_level, temperature_alert, pressure_alert, vibration_alert")


REFINED_COLUMNS = [c.strip() for c in REFINED_ORACLE_COLS.split(",")]


@register("refined", oracle.sql(f"SELECT {REFINED_ORACLE_COLS} FROM refined"))
def q_refined(spark, sf):
    return refine.refined(spark, sf).drop("ingestion_timestamp", "processing_timestamp")


@register("quarantine", oracle.sql("SELECT arrival_seq, event_id, device_id, error_reason FROM quarantine"))
def q_quarantine(spark, sf):
    return refine.quarantined(spark, sf).select("arrival_seq", "event_id", "device_id", "error_reason")


@register("dq_flags", oracle.sql("SELECT arrival_seq, error_reason IS NULL AS is_valid FROM dq"))
def q_dq_flags(spark, sf):
    return quality.check(tel.telemetry(spark, sf)).select("arrival_seq", "is_valid")


@register("dq_reasons", oracle.sql("SELECT arrival_seq, error_reason FROM dq"))
def q_dq_reasons(spark, sf):
    return quality.check(tel.telemetry(spark, sf)).select("arrival_seq", "error_reason")


@register("dq_labels", oracle.sql(
    "SELECT CASE WHEN error_reason IS NULL THEN 'VALID' ELSE 'INVALID' END AS dq_status, COUNT(*) AS n "
    "FROM dq GROUP BY 1"))
def q_dq_labels(spark, sf):
    labelled = quality.validity_label(quality.check(tel.telemetry(spark, sf)))
    return labelled.groupBy("dq_status").agg(F.count(F.lit(1)).alias("n"))


@register("dq_split_counts", oracle.sql(
    "SELECT COUNT(*) AS raw_count, COUNT(*) FILTER (WHERE error_reason IS NULL) AS valid_count, "
    "COUNT(*) FILTER (WHERE error_reason IS NOT NULL) AS invalid_count FROM dq"))
def q_dq_split_counts(spark, sf):
    return quality.split_counts(quality.check(tel.telemetry(spark, sf)))


@register("dq_codes_array", oracle.sql("""
SELECT arrival_seq, NULLIF(CONCAT_WS(', ',
  CASE WHEN event_id IS NULL OR event_id = '' THEN 'event_id_null' END,
  CASE WHEN device_id IS NULL OR device_id = '' THEN 'device_id_null' END,
  CASE WHEN event_timestamp IS NULL OR event_timestamp = '' THEN 'event_timestamp_null' END,
  CASE WHEN event_timestamp <> '' AND TRY_CAST(event_timestamp AS TIMESTAMPTZ) IS NULL THEN 'event_timestamp_invalid' END,
  CASE WHEN temperature IS NULL THEN 'temperature_null' END,
  CASE WHEN temperature < 0 OR temperature > 200 OR isnan(temperature) THEN 'temperature_out_of_range' END,
  CASE WHEN pressure IS NULL THEN 'pressure_null' END,
  CASE WHEN pressure < 0 OR isnan(pressure) THEN 'pressure_negative' END,
  CASE WHEN vibration IS NULL THEN 'vibration_null' END,
  CASE WHEN vibration < 0 OR isnan(vibration) THEN 'vibration_negative' END,
  CASE WHEN rpm IS NULL THEN 'rpm_null' END,
  CASE WHEN rpm < 0 THEN 'rpm_negative' END,
  CASE WHEN status IS NULL OR status NOT IN ('RUNNING', 'STOPPED', 'MAINTENANCE', 'FAILURE') THEN 'invalid_status' END
), '') AS codes FROM telemetry"""))
def q_dq_codes_array(spark, sf):
    checked = quality.with_failed_codes(quality.check(tel.telemetry(spark, sf), null_codes=True))
    return checked.select("arrival_seq", F.when(F.size("failed_codes") > 0,
                                                F.concat_ws(", ", "failed_codes")).alias("codes"))


@register("dedup_first", oracle.sql("SELECT arrival_seq, event_id FROM refined"))
def q_dedup_first(spark, sf):
    checked = quality.check(tel.telemetry(spark, sf))
    firsts = dedup.dedup_first(checked, "event_id", "arrival_seq", prefer="is_valid").filter(F.col("is_valid"))
    return firsts.select("arrival_seq", "event_id")


@register("dedup_count", oracle.sql("SELECT COUNT(DISTINCT event_id) AS n FROM valid"))
def q_dedup_count(spark, sf):
    valid, _ = quality.split(quality.check(tel.telemetry(spark, sf)))
    return dedup.dedup_any(valid).agg(F.count(F.lit(1)).alias("n"))


@register("alert_flags", oracle.sql(
    "SELECT event_id, temperature_alert, pressure_alert, vibration_alert FROM refined"))
def q_alert_flags(spark, sf):
    return refine.refined(spark, sf).select("event_id", "temperature_alert", "pressure_alert", "vibration_alert")


@register("anomaly_levels", oracle.sql("SELECT event_id, anomaly_level FROM refined"))
def q_anomaly_levels(spark, sf):
    return refine.refined(spark, sf).select("event_id", "anomaly_level")


@register("event_time_parse", oracle.sql("SELECT arrival_seq, event_timestamp FROM refined"))
def q_event_time_parse(spark, sf):
    return refine.refined(spark, sf).select("arrival_seq", "event_timestamp")


# --- analytic queries ------------------------------------------------------------------------------------------

@register("critical_now", oracle.sql(
    "SELECT device_id, last_event_timestamp, temperature, pressure, vibration, anomaly_level FROM current_status "
    "WHERE anomaly_level = 'CRITICAL'"))
def q_critical_now(spark, sf):
    return analytics.critical_now(latest.current_status(store.refined_table(spark, sf)))


@register("top_temperature", oracle.sql(
    "SELECT device_id, event_id, event_timestamp, temperature, anomaly_level FROM refined "
    "ORDER BY temperature DESC, event_id LIMIT 5"))
def q_top_temperature(spark, sf):
    return analytics.top_by(store.refined_table(spark, sf), "temperature")


@register("top_vibration", oracle.sql(
    "SELECT device_id, event_id, event_timestamp, vibration, anomaly_level FROM refined "
    "ORDER BY vibration DESC, event_id LIMIT 5"))
def q_top_vibration(spark, sf):
    return analytics.top_by(store.refined_table(spark, sf), "vibration")


@register("total_events", oracle.sql("SELECT COUNT(*) AS total_processed_events FROM refined"))
def q_total_events(spark, sf):
    return analytics.total_events(store.refined_table(spark, sf))


@register("events_by_status", oracle.sql(
    "SELECT machine_status, COUNT(*) AS event_count FROM refined GROUP BY machine_status"))
def q_events_by_status(spark, sf):
    return analytics.count_by(store.refined_table(spark, sf), "machine_status")


@register("events_by_anomaly", oracle.sql(
    "SELECT anomaly_level, COUNT(*) AS event_count FROM refined GROUP BY anomaly_level"))
def q_events_by_anomaly(spark, sf):
    return analytics.count_by(store.refined_table(spark, sf), "anomaly_level")


AVG2 = ("CAST(CASE WHEN s{x} < 0 THEN -((2 * (-s{x}) + n) // (2 * n)) ELSE (2 * s{x} + n) // (2 * n) END AS DOUBLE)"
        " / 1.0E2 AS avg_{name}")


def _avg2(x: str, name: str) -> str:
    return AVG2.format(x=x, name=name)


@register("avg_by_device", oracle.sql(
    f"SELECT device_id, {_avg2('t', 'temperature')}, {_avg2('p', 'pressure')}, {_avg2('v', 'vibration')}, "
    "n AS total_measurements FROM ("
    " SELECT device_id, CAST(SUM(CAST(temperature AS DECIMAL(18,2))) * 100 AS BIGINT) AS st,"
    " CAST(SUM(CAST(pressure AS DECIMAL(18,2))) * 100 AS BIGINT) AS sp,"
    " CAST(SUM(CAST(vibration AS DECIMAL(18,2))) * 100 AS BIGINT) AS sv, COUNT(*) AS n"
    " FROM refined GROUP BY device_id)"))
def q_avg_by_device(spark, sf):
    return analytics.avg_by_device(store.refined_table(spark, sf))


@register("alerts_by_device", oracle.sql(
    "SELECT device_id, count_if(temperature > 75) AS temp_alerts, count_if(pressure > 5) AS press_alerts, count_if(vibration > 6) AS vib_alerts,"
    " count_if(greatest(temperature / 75, pressure / 5, vibration / 6) > 1) AS total_alerts FROM firsts WHERE rn = 1 GROUP BY device_id"))
def q_alerts_by_device(spark, sf):
    return analytics.alerts_by_device(store.refined_table(spark, sf))


@register("anomaly_by_device", oracle.sql(
    "SELECT device_id, COUNT(*) FILTER (WHERE anomaly_level = 'NORMAL') AS normal_count,"
    " COUNT(*) FILTER (WHERE anomaly_level = 'WARNING') AS warning_count,"
    " COUNT(*) FILTER (WHERE anomaly_level = 'CRITICAL') AS critical_count FROM refined GROUP BY device_id"))
def q_anomaly_by_device(spark, sf):
    return analytics.anomaly_by_device(store.refined_table(spark, sf))


@register("rejected_total", oracle.sql("SELECT COUNT(*) AS rejected_events FROM quarantine"))
def q_rejected_total(spark, sf):
    return analytics.rejected_total(refine.quarantined(spark, sf))


@register("current_status", oracle.sql(
    "SELECT device_id, last_event_id, last_event_timestamp, temperature, pressure, vibration, rpm, machine_status,"
    " anomaly_level FROM current_status"))
def q_current_status(spark, sf):
    return latest.current_status(store.refined_table(spark, sf)).drop("updated_at")


# --- shared SQL fragments ---------------------------------------------------------------------------------------

def avg2_sql(s: str, n: str, name: str) -> str:
    return (f"CAST(CASE WHEN {s} < 0 THEN -((2 * (-{s}) + {n}) // (2 * {n})) ELSE (2 * {s} + {n}) // (2 * {n}) END"
            f" AS DOUBLE) / 1.0E2 AS {name}")


def hundredths_sql(x: str, over: str = "") -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))){over} * 100 AS BIGINT)"


NORM = """
norm AS (
  SELECT arrival_seq, COALESCE(event_id, 'N/A') AS event_id, COALESCE(device_id, 'UNKNOWN') AS device_id,
         event_timestamp, COALESCE(temperature, 0.0E0) AS temperature, COALESCE(pressure, 0.0E0) AS pressure,
         COALESCE(vibration, 0.0E0) AS vibration, rpm, UPPER(COALESCE(status, 'UNKNOWN')) AS status
  FROM telemetry
)"""

MAINT = """
mnorm AS (
  SELECT arrival_seq, event_id, device_id, temperature, pressure, vibration, UPPER(machine_status) AS status
  FROM refined
),
mstate AS (
  SELECT arrival_seq, device_id, event_id, status,
    COUNT(*) OVER w AS total_cycles,
    CAST(SUM(CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS running_cycles,
    SUM(CAST(vibration AS DECIMAL(18,2))) OVER w AS acc,
    CAST(SUM(CASE WHEN temperature > 75 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hot,
    CAST(SUM(CASE WHEN pressure > 5 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS high_press,
    CAST(SUM(CASE WHEN status = 'FAILURE' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS failures
  FROM mnorm
  WINDOW w AS (PARTITION BY device_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
mscore AS (
  SELECT *,
    CAST(GREATEST(0, ROUND(100 - LEAST(50, CAST(acc AS DECIMAL(18,4)) * 0.5)
                               - LEAST(50, CAST(hot AS DECIMAL(18,4)) * 2.5), 1)) AS DOUBLE) AS health_score,
    CONCAT_WS('; ',
      CASE WHEN acc >= 100 THEN 'Excessive Accumulated Vibration (' || CAST(CAST(acc AS DOUBLE) AS VARCHAR)
                                || ' >= 100.0)' END,
      CASE WHEN hot >= 20 THEN 'High Temperature Operating Limit (' || CAST(hot AS VARCHAR) || ' >= 20 cycles)' END,
      CASE WHEN status = 'FAILURE' THEN 'Catastrophic Machine Failure Detected' END) AS reasons
  FROM mstate
),
wo AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY arrival_seq) AS r
                 FROM mscore WHERE reasons <> '') WHERE r = 1
)"""


# --- consumers: alerts -------------------------------------------------------------------------------------------

@register("normalize_consumer_input", oracle.sql(
    "SELECT arrival_seq, event_id, device_id, temperature, pressure, vibration, status FROM norm", NORM))
def q_normalize_consumer_input(spark, sf):
    n = consumers.normalize(tel.telemetry(spark, sf))
    return n.select("arrival_seq", "event_id", "device_id", "temperature", "pressure", "vibration", "status")


ALERTS_SQL = """
SELECT 'alt-' || sha256(event_id) AS alert_id, device_id, event_id, 'CRITICAL' AS severity,
  COALESCE(NULLIF(CONCAT_WS('; ',
    CASE WHEN temperature > 90 THEN 'Temperature CRITICAL (' || CAST(temperature AS VARCHAR) || '°C > 90.0°C)' END,
    CASE WHEN vibration > 15 THEN 'Vibration CRITICAL (' || CAST(vibration AS VARCHAR) || ' mm/s > 15.0 mm/s)' END,
    CASE WHEN pressure > 7 THEN 'Pressure CRITICAL (' || CAST(pressure AS VARCHAR) || ' bar > 7.0 bar)' END,
    CASE WHEN status = 'FAILURE' THEN 'Machine Status FAILURE' END), ''), 'Anomaly Level CRITICAL Flagged') AS reasons,
  temperature, pressure, vibration, status, event_timestamp
FROM norm WHERE temperature > 90 OR vibration > 15 OR pressure > 7 OR status = 'FAILURE'"""


@register("alerts", oracle.sql(ALERTS_SQL, NORM))
def q_alerts(spark, sf):
    return consumers.flat_alerts(consumers.alerts(tel.telemetry(spark, sf)))


# --- consumers: metrics ------------------------------------------------------------------------------------------

def _metric_cols_sql(n: str) -> str:
    parts = []
    for m, a in (("temperature", "t"), ("pressure", "p"), ("vibration", "v")):
        parts.append(avg2_sql(f"s{a}", n, f"avg_{m}"))
        parts.append(f"min_{m}")
        parts.append(f"max_{m}")
    return ", ".join(parts)


#: Count, averages and extremes of a device's readings, and the time of the one that arrived last.
DEVICE_METRICS_SQL = (
    f"SELECT device_id, total_events, {_metric_cols_sql('total_events')}, last_event_timestamp FROM ("
    " SELECT device_id, COUNT(*) AS total_events,"
    f" {hundredths_sql('temperature')} AS st, MIN(temperature) AS min_temperature, MAX(temperature) AS max_temperature,"
    f" {hundredths_sql('pressure')} AS sp, MIN(pressure) AS min_pressure, MAX(pressure) AS max_pressure,"
    f" {hundredths_sql('vibration')} AS sv, MIN(vibration) AS min_vibration, MAX(vibration) AS max_vibration,"
    " (array_agg(event_timestamp ORDER BY arrival_seq DESC))[1] AS last_event_timestamp FROM norm GROUP BY device_id)")

#: A device's readings by status, as one text ``STATUS=n;...``.
STATUSES_SQL = (
    "SELECT device_id, string_agg(status || '=' || CAST(c AS VARCHAR), ';' ORDER BY status || '=' || CAST(c AS VARCHAR)) AS statuses"
    " FROM (SELECT device_id, status, COUNT(*) AS c FROM norm GROUP BY ALL) GROUP BY device_id")


def _statuses(df: DataFrame) -> DataFrame:
    """The map of readings by status as the text that ``STATUSES_SQL`` gives."""
    entries = F.expr("transform(map_entries(status_distribution), e -> concat(e.key, '=', e.value))")
    return df.withColumn("statuses", F.array_join(F.array_sort(entries), ";")).drop("status_distribution")


@register("device_metrics", oracle.sql(DEVICE_METRICS_SQL, NORM))
def q_device_metrics(spark, sf):
    return consumers.device_metrics(tel.telemetry(spark, sf)).drop("updated_at")


@register("status_distribution", oracle.sql(
    "SELECT device_id, status, COUNT(*) AS n FROM norm GROUP BY device_id, status", NORM))
def q_status_distribution(spark, sf):
    return consumers.status_distribution(tel.telemetry(spark, sf))


@register("status_map", oracle.sql(STATUSES_SQL, NORM))
def q_status_map(spark, sf):
    return _statuses(consumers.status_distribution(tel.telemetry(spark, sf), nested=True))


@register("fleet_summary", oracle.sql(
    "SELECT COUNT(*) AS total_processed_events, COUNT(DISTINCT device_id) AS total_active_devices FROM norm", NORM))
def q_fleet_summary(spark, sf):
    return consumers.fleet_summary(tel.telemetry(spark, sf)).drop("generated_at")


@register("fleet_devices_by_day", oracle.sql(
    "SELECT d.event_date, COUNT(*) FILTER (WHERE r.event_date = d.event_date) AS events,"
    " COUNT(DISTINCT CASE WHEN r.event_date = d.event_date THEN device_id END) AS devices, COUNT(DISTINCT device_id) AS devices_of_week"
    " FROM (SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date FROM refined) d"
    " JOIN (SELECT CAST(event_timestamp AS DATE) AS event_date, device_id FROM refined) r"
    " ON r.event_date BETWEEN d.event_date - 6 AND d.event_date GROUP BY d.event_date"))
def q_fleet_devices_by_day(spark, sf):
    """From the stored sketches alone; counts as small as these are exact."""
    days = store.sketch_table(spark, sf)
    week = sketches.devices(days, 7).select("event_date", F.col("devices").alias("devices_of_week"))
    return sketches.devices(days).join(week, "event_date")


_W_ALL = "OVER (PARTITION BY device_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("running_metrics", oracle.sql(
    f"SELECT arrival_seq, device_id, total_events, {_metric_cols_sql('total_events')} FROM ("
    f" SELECT arrival_seq, device_id, COUNT(*) {_W_ALL} AS total_events,"
    f" {hundredths_sql('temperature', ' ' + _W_ALL)} AS st, MIN(temperature) {_W_ALL} AS min_temperature,"
    f" MAX(temperature) {_W_ALL} AS max_temperature,"
    f" {hundredths_sql('pressure', ' ' + _W_ALL)} AS sp, MIN(pressure) {_W_ALL} AS min_pressure,"
    f" MAX(pressure) {_W_ALL} AS max_pressure,"
    f" {hundredths_sql('vibration', ' ' + _W_ALL)} AS sv, MIN(vibration) {_W_ALL} AS min_vibration,"
    f" MAX(vibration) {_W_ALL} AS max_vibration FROM norm)", NORM))
def q_running_metrics(spark, sf):
    return consumers.running_metrics(tel.telemetry(spark, sf))


# --- consumers: archive ------------------------------------------------------------------------------------------

ARCHIVE_DAY = ("COALESCE(try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ'),"
               " CAST(timezone('UTC', current_timestamp) AS TIMESTAMP))")


@register("archive_records", oracle.sql(
    "SELECT 'iot-machine-events' AS _source_topic, arrival_seq, event_id, device_id, event_timestamp, temperature,"
    " pressure, vibration, rpm, status,"
    f" strftime({ARCHIVE_DAY}, '%Y') AS year, strftime({ARCHIVE_DAY}, '%m') AS month,"
    f" strftime({ARCHIVE_DAY}, '%d') AS day FROM telemetry"))
def q_archive_records(spark, sf):
    a = consumers.archive_records(tel.telemetry(spark, sf))
    return a.select("_source_topic", "raw_payload.*", "year", "month", "day")


# --- consumers: dead letters -------------------------------------------------------------------------------------

DLQN = """
dlqn AS (
  SELECT arrival_seq, COALESCE(event_id, 'N/A') AS event_id, COALESCE(NULLIF(device_id, ''), 'UNKNOWN_DEVICE') AS device_id,
         COALESCE(NULLIF(error_reason, ''), 'unspecified_error') AS error_reason
  FROM quarantine
)"""


@register("dlq_records", oracle.sql(
    "SELECT arrival_seq, 'dlq-' || CAST(ROW_NUMBER() OVER (ORDER BY arrival_seq) AS VARCHAR) AS quarantine_id,"
    " event_id, device_id, error_reason FROM dlqn", DLQN))
def q_dlq_records(spark, sf):
    return consumers.dlq_records(store.quarantine_table(spark, sf)).drop("processed_at")


@register("dlq_by_reason", oracle.sql("SELECT error_reason, COUNT(*) AS n FROM dlqn GROUP BY error_reason", DLQN))
def q_dlq_by_reason(spark, sf):
    return consumers.dlq_by_reason(refine.quarantined(spark, sf))


@register("dlq_by_device", oracle.sql("SELECT device_id, COUNT(*) AS n FROM dlqn GROUP BY device_id", DLQN))
def q_dlq_by_device(spark, sf):
    return consumers.dlq_by_device(refine.quarantined(spark, sf))


@register("dlq_by_code", oracle.sql(
    "SELECT code, COUNT(*) AS n FROM (SELECT UNNEST(string_split(error_reason, ', ')) AS code FROM dlqn) GROUP BY code",
    DLQN))
def q_dlq_by_code(spark, sf):
    return consumers.dlq_by_code(refine.quarantined(spark, sf))


@register("dlq_rate_by_device", oracle.sql(
    "SELECT COALESCE(NULLIF(device_id, ''), 'UNKNOWN_DEVICE') AS device_id, COUNT(*) AS total,"
    " COUNT(*) FILTER (WHERE error_reason IS NOT NULL) AS rejected,"
    " CAST(COUNT(*) FILTER (WHERE error_reason IS NOT NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS reject_rate"
    " FROM dq GROUP BY 1"))
def q_dlq_rate_by_device(spark, sf):
    return consumers.dlq_rate_by_device(quality.check(tel.telemetry(spark, sf)))


@register("dlq_summary", oracle.sql(
    "SELECT COUNT(*) AS total_quarantined_events, COUNT(DISTINCT error_reason) AS distinct_reasons,"
    " COUNT(DISTINCT device_id) AS distinct_devices FROM dlqn", DLQN))
def q_dlq_summary(spark, sf):
    return consumers.dlq_summary(refine.quarantined(spark, sf)).drop("last_processed_at")


@register("dlq_threshold", oracle.sql(
    "SELECT error_reason, COUNT(*) AS n FROM dlqn GROUP BY error_reason HAVING COUNT(*) >= 10", DLQN))
def q_dlq_threshold(spark, sf):
    return consumers.dlq_threshold(refine.quarantined(spark, sf))


@register("dlq_alarms", oracle.sql(
    "SELECT error_reason, arrival_seq AS alarm_at, event_id, device_id FROM (SELECT *, ROW_NUMBER() OVER"
    " (PARTITION BY error_reason ORDER BY arrival_seq) AS r FROM dlqn) WHERE r = 10", DLQN))
def q_dlq_alarms(spark, sf):
    return consumers.dlq_alarms(store.quarantine_table(spark, sf))


# --- consumers: maintenance --------------------------------------------------------------------------------------

@register("maintenance_state", oracle.sql(
    "SELECT arrival_seq, device_id, total_cycles, running_cycles, CAST(acc AS DOUBLE) AS accumulated_vibration,"
    " hot AS high_temp_cycles, high_press AS high_pressure_cycles,"
    " (acc >= 100 OR hot >= 20 OR failures > 0) AS maintenance_required FROM mstate", MAINT))
def q_maintenance_state(spark, sf):
    s = consumers.maintenance_state(store.refined_table(spark, sf))
    return s.select("arrival_seq", "device_id", "total_cycles", "running_cycles", "accumulated_vibration",
                    "high_temp_cycles", "high_pressure_cycles", "maintenance_required")


def _falling(raw):
    """Raw readings, of which every third has a negative vibration (a sensor that drifts)."""
    return raw.withColumn("vibration", F.expr("CASE WHEN arrival_seq % 3 = 1 THEN -vibration ELSE vibration END"))


RAW_MAINT = """
mstate AS (
  SELECT arrival_seq, device_id,
    SUM(CAST(CASE WHEN arrival_seq % 3 = 1 THEN -vibration ELSE vibration END AS DECIMAL(18,2))) OVER w AS acc,
    SUM(CASE WHEN temperature > 75 THEN 1 ELSE 0 END) OVER w AS hot,
    SUM(CASE WHEN UPPER(COALESCE(status, 'UNKNOWN')) = 'FAILURE' THEN 1 ELSE 0 END) OVER w AS failures
  FROM (SELECT arrival_seq, COALESCE(device_id, 'UNKNOWN') AS device_id, COALESCE(vibration, 0) AS vibration, temperature, status FROM telemetry)
  WINDOW w AS (PARTITION BY device_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


@register("health_scores", oracle.sql("SELECT arrival_seq, device_id, health_score FROM mscore", MAINT))
def q_health_scores(spark, sf):
    return consumers.maintenance_state(store.refined_table(spark, sf)).select("arrival_seq", "device_id", "health_score")


@register("maintenance_reasons", oracle.sql("SELECT arrival_seq, device_id, reasons FROM mscore", MAINT))
def q_maintenance_reasons(spark, sf):
    s = consumers.maintenance_state(store.refined_table(spark, sf))
    return s.select("arrival_seq", "device_id", text.joined(F.col("reasons")).alias("reasons"))


@register("work_orders", oracle.sql(
    "SELECT 'WO-' || device_id || '-' || CAST(total_cycles AS VARCHAR) AS work_order_id, device_id,"
    " event_id AS trigger_event_id, CASE WHEN status = 'FAILURE' THEN 'HIGH' ELSE 'MEDIUM' END AS priority,"
    " health_score, reasons FROM wo", MAINT))
def q_work_orders(spark, sf):
    return _flat_orders(consumers.work_orders(consumers.maintenance_state(store.refined_table(spark, sf))))


def _flat_orders(w: DataFrame) -> DataFrame:
    return w.select("work_order_id", "device_id", "trigger_event_id", "priority", "health_score",
                    text.joined(F.col("reasons")).alias("reasons"))


LIFE_SQL = """
SELECT f.device_id, total_cycles, running_cycles, CAST(acc AS DOUBLE) AS accumulated_vibration, high_temp_cycles,
  high_pressure_cycles, last_status, w.wo_device IS NOT NULL AS maintenance_required,
  COALESCE(w.wo_reasons, '') AS maintenance_reasons,
  CAST(GREATEST(0, ROUND(100 - LEAST(50, CAST(acc AS DECIMAL(18,4)) * 0.5)
                             - LEAST(50, CAST(high_temp_cycles AS DECIMAL(18,4)) * 2.5), 1)) AS DOUBLE) AS health_score
FROM (SELECT device_id, COUNT(*) AS total_cycles, COUNT(*) FILTER (WHERE status = 'RUNNING') AS running_cycles,
        SUM(CAST(vibration AS DECIMAL(18,2))) AS acc, COUNT(*) FILTER (WHERE temperature > 75) AS high_temp_cycles,
        COUNT(*) FILTER (WHERE pressure > 5) AS high_pressure_cycles, arg_max(status, arrival_seq) AS last_status
      FROM mnorm GROUP BY device_id) f
LEFT JOIN (SELECT device_id AS wo_device, reasons AS wo_reasons FROM wo) w ON f.device_id = w.wo_device"""


@register("lifecycle_by_device", oracle.sql(LIFE_SQL, MAINT))
def q_lifecycle_by_device(spark, sf):
    d = consumers.lifecycle_by_device(store.refined_table(spark, sf))
    return d.withColumn("maintenance_reasons", text.joined(F.col("maintenance_reasons")))


@register("lifecycle_summary", oracle.sql(
    "SELECT COUNT(*) AS monitored_devices_count, COUNT(*) FILTER (WHERE maintenance_required) AS open_work_orders_count"
    f" FROM ({LIFE_SQL})", MAINT))
def q_lifecycle_summary(spark, sf):
    return consumers.lifecycle_summary(consumers.lifecycle_by_device(store.refined_table(spark, sf))).drop("updated_at")


# --- event-time windows and row frames ---------------------------------------------------------------------------

@register("tumbling_metrics", oracle.sql(
    "SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start,"
    " time_bucket(INTERVAL '1 hour', event_timestamp) + INTERVAL '1 hour' AS window_end, device_id, COUNT(*) AS n,"
    " CAST(SUM(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(temperature) AS DOUBLE) AS avg_temperature,"
    " MAX(temperature) AS max_temperature FROM refined GROUP BY ALL"))
def q_tumbling_metrics(spark, sf):
    return windows.tumbling(store.refined_table(spark, sf), "1 hour")


@register("sliding_counts", oracle.sql(
    "SELECT ws AS window_start, ws + INTERVAL '2 hours' AS window_end, device_id, COUNT(*) AS n FROM ("
    " SELECT device_id, UNNEST([time_bucket(INTERVAL '1 hour', event_timestamp),"
    " time_bucket(INTERVAL '1 hour', event_timestamp) - INTERVAL '1 hour']) AS ws FROM refined) GROUP BY ALL"))
def q_sliding_counts(spark, sf):
    return windows.sliding(store.refined_table(spark, sf), "2 hours", "1 hour")


@register("device_sessions", oracle.sql(
    "SELECT device_id, MIN(event_timestamp) AS session_start, MAX(event_timestamp) + INTERVAL '6 hours' AS session_end,"
    " COUNT(*) AS n FROM (SELECT device_id, event_timestamp, SUM(new_s) OVER (PARTITION BY device_id"
    " ORDER BY event_timestamp, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM ("
    " SELECT device_id, event_timestamp, arrival_seq, CASE WHEN LAG(event_timestamp) OVER (PARTITION BY device_id"
    " ORDER BY event_timestamp, arrival_seq) IS NULL OR event_timestamp - LAG(event_timestamp) OVER (PARTITION BY"
    " device_id ORDER BY event_timestamp, arrival_seq) >= INTERVAL '6 hours' THEN 1 ELSE 0 END AS new_s FROM refined))"
    " GROUP BY device_id, sid"))
def q_device_sessions(spark, sf):
    return windows.sessions(store.refined_table(spark, sf), "6 hours")


@register("moving_avg", oracle.sql(
    "SELECT device_id, arrival_seq, CAST(SUM(CAST(temperature AS DECIMAL(18,2))) OVER w AS DOUBLE)"
    " / CAST(COUNT(temperature) OVER w AS DOUBLE) AS moving_avg_temperature FROM refined"
    " WINDOW w AS (PARTITION BY device_id ORDER BY arrival_seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"))
def q_moving_avg(spark, sf):
    return windows.moving_avg(store.refined_table(spark, sf), 10, "temperature")


@register("moving_avg_day", oracle.sql(
    "SELECT device_id, arrival_seq, CAST(SUM(CAST(temperature AS DECIMAL(18,2))) OVER w AS DOUBLE)"
    " / CAST(COUNT(temperature) OVER w AS DOUBLE) AS moving_avg_temperature FROM refined"
    " WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND CURRENT ROW)"))
def q_moving_avg_day(spark, sf):
    return windows.moving_avg_range(store.refined_table(spark, sf), 24 * 60, "temperature")


@register("late_events", oracle.sql(
    "SELECT arrival_seq, device_id, event_timestamp < MAX(event_timestamp) OVER (PARTITION BY device_id"
    " ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '10 minutes' AS is_late"
    " FROM refined"))
def q_late_events(spark, sf):
    return windows.late_flag(store.refined_table(spark, sf), 10).select("arrival_seq", "device_id", "is_late")


# --- topic-side logic --------------------------------------------------------------------------------------------

def _raw_payloads(spark, sf):
    """Payload texts derived from the readings, with junk payloads injected by fixed rules on the arrival order."""
    t = tel.telemetry(spark, sf)
    a = F.col("arrival_seq")
    obj = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","device_id":"'), F.col("device_id"), F.lit('"}'))
    v = (F.when(a % 31 == 0, F.concat(F.lit("not json "), F.col("event_id")))
          .when(a % 37 == 0, F.concat(F.lit("["), a.cast("string"), F.lit("]")))
          .when(a % 41 == 0, F.lit("{}")).when(a % 43 == 0, F.lit('"scalar"')).when(a % 47 == 0, F.lit(""))
          .otherwise(obj))
    return t.select("arrival_seq", v.alias("value"))


PAYLOADS = """
payloads AS (
  SELECT arrival_seq, CASE WHEN arrival_seq % 31 = 0 THEN 'not json ' || event_id
    WHEN arrival_seq % 37 = 0 THEN '[' || CAST(arrival_seq AS VARCHAR) || ']' WHEN arrival_seq % 41 = 0 THEN '{}'
    WHEN arrival_seq % 43 = 0 THEN '"scalar"' WHEN arrival_seq % 47 = 0 THEN ''
    ELSE '{"event_id":"' || event_id || '","device_id":"' || device_id || '"}' END AS value
  FROM telemetry
)"""


@register("envelope_check", oracle.sql(
    "SELECT arrival_seq, COALESCE(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT'"
    " AND len(json_keys(value)) > 0 END, false) AS accepted FROM payloads", PAYLOADS))
def q_envelope_check(spark, sf):
    return envelope.valid_envelope(_raw_payloads(spark, sf)).select("arrival_seq", "accepted")


@register("parse_events", oracle.sql(
    "SELECT arrival_seq, event_id, device_id, event_timestamp, temperature, pressure, vibration, rpm, status,"
    " CAST(NULL AS VARCHAR) AS machine_type, CAST(NULL AS VARCHAR) AS location FROM telemetry"))
def q_parse_events(spark, sf):
    payload = envelope.to_payload(tel.telemetry(spark, sf))
    return envelope.parse(payload, keep_raw=False)


@register("topic_envelope", oracle.sql(
    "SELECT NULLIF(device_id, '') AS key, COUNT(*) AS n FROM telemetry GROUP BY 1"))
def q_topic_envelope(spark, sf):
    return envelope.keyed_records(tel.telemetry(spark, sf)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@register("topic_route", oracle.sql(
    "SELECT arrival_seq, topic, regexp_matches(topic, '^industrial/machines/([^/]*)/telemetry$') AS matched,"
    " CASE WHEN regexp_matches(topic, '^industrial/machines/([^/]*)/telemetry$')"
    " THEN regexp_extract(topic, '^industrial/machines/([^/]*)/telemetry$', 1) END AS routed_device FROM ("
    " SELECT arrival_seq, 'industrial/machines/' || device_id || CASE WHEN arrival_seq % 7 = 0 THEN '/status'"
    " WHEN arrival_seq % 11 = 0 THEN '/part/telemetry' ELSE '/telemetry' END AS topic FROM telemetry)"))
def q_topic_route(spark, sf):
    """Topics of readings, and of other messages that the subscription does not match."""
    topic, a = envelope.topic_for(F.col("device_id")), F.col("arrival_seq")
    other = F.when(a % 7 == 0, F.replace(topic, F.lit("/telemetry"), F.lit("/status"))).when(a % 11 == 0, F.replace(topic, F.lit("/telemetry"), F.lit("/part/telemetry")))
    return envelope.route(tel.telemetry(spark, sf).select("arrival_seq", F.coalesce(other, topic).alias("topic")))


# --- point lookups, constraints, keyed merge ---------------------------------------------------------------------

@register("lookup_event", oracle.sql(f"SELECT {REFINED_ORACLE_COLS} FROM refined WHERE event_id = 'evt-500'"))
def q_lookup_event(spark, sf):
    return analytics.lookup(store.refined_table(spark, sf), REFINED_COLUMNS, event_id="evt-500")


@register("lookup_event_located", ORACLES["lookup_event"])
def q_lookup_event_located(spark, sf):
    """The same by the locator of ids: one bucket of it and one day of the table are opened."""
    return store.find_events(store.refined_table(spark, sf), store.locator_table(spark, sf), ["evt-500"]).select(*REFINED_COLUMNS)


@register("lookup_device_time", oracle.sql(
    "SELECT event_id, device_id, event_timestamp, temperature, pressure, anomaly_level FROM refined"
    " WHERE device_id = 'MTR-0027' AND event_timestamp = TIMESTAMP '2024-01-03 06:03:33.431023'"))
def q_lookup_device_time(spark, sf):
    r = store.refined_table(spark, sf)
    return r.filter((F.col("event_date") == F.lit("2024-01-03").cast("date")) & (F.col("device_id") == "MTR-0027")
                    & (F.col("event_timestamp") == F.lit("2024-01-03 06:03:33.431023").cast("timestamp"))).select(
        "event_id", "device_id", "event_timestamp", "temperature", "pressure", "anomaly_level")


def _clustered(spark, sf) -> str:
    return store.stored(spark, sf, "clustered-table", lambda path: clustered.write_clustered(store.refined_table(spark, sf), path))


@register("lookup_device_time_zoned", ORACLES["lookup_device_time"])
def q_lookup_device_time_zoned(spark, sf):
    """The same from the clustered table: files whose zones hold the device and the time are opened."""
    at = dt.datetime(2024, 1, 3, 6, 3, 33, 431023, tzinfo=dt.timezone.utc)
    return clustered.find(spark, _clustered(spark, sf), device="MTR-0027", since=at, until=at).select(
        "event_id", "device_id", "event_timestamp", "temperature", "pressure", "anomaly_level")


@register("device_span_zoned", oracle.sql(
    f"SELECT {REFINED_ORACLE_COLS} FROM refined WHERE device_id = 'MTR-0027' AND anomaly_level = 'CRITICAL'"
    " AND event_timestamp BETWEEN TIMESTAMP '2024-01-02 12:00:00' AND TIMESTAMP '2024-01-20 18:30:00'"))
def q_device_span_zoned(spark, sf):
    """Critical readings of a device over a span of time that begins and ends inside a day."""
    since, until = dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 20, 18, 30, tzinfo=dt.timezone.utc)
    return clustered.find(spark, _clustered(spark, sf), "MTR-0027", since, until, "CRITICAL").select(*REFINED_COLUMNS)


@register("lookup_metrics", oracle.sql(
    f"SELECT {REFINED_ORACLE_COLS} FROM refined WHERE device_id = 'MTR-0029' AND temperature = 39.14E0"
    " AND pressure = 1.84E0"))
def q_lookup_metrics(spark, sf):
    return analytics.lookup(store.refined_table(spark, sf), REFINED_COLUMNS, device_id="MTR-0029", temperature=39.14, pressure=1.84)


@register("refined_constraints", oracle.sql(
    "SELECT (SELECT COUNT(*) - COUNT(DISTINCT event_id) FROM refined) AS duplicate_keys, "
    + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in
                ["event_id", "device_id", "event_timestamp", "temperature", "pressure", "vibration", "rpm",
                 "machine_status", "anomaly_level", "temperature_alert", "pressure_alert", "vibration_alert"])
    + ", CAST(0 AS BIGINT) AS null_ingestion_timestamp FROM refined"))
def q_refined_constraints(spark, sf):
    return quality.constraint_violations(store.refined_table(spark, sf), "event_id", schemas.REFINED_NOT_NULL)


@register("current_status_merge", oracle.sql(
    "SELECT device_id, last_event_id, last_event_timestamp, temperature, pressure, vibration, rpm, machine_status,"
    " anomaly_level FROM current_status"))
def q_current_status_merge(spark, sf):
    r = store.refined_table(spark, sf)
    first = latest.merge_snapshot(None, r.filter(F.col("arrival_seq") % 2 == 1))
    second = latest.merge_snapshot(first, r.filter(F.col("arrival_seq") % 2 == 0))
    return second.drop("last_arrival_seq")


# --- streaming queries and sinks (run to completion, sink read back) ---------------------------------------------

@register("stream_bronze", oracle.sql(
    "SELECT arrival_seq, event_id, device_id, event_timestamp, temperature, pressure, vibration, rpm, status"
    " FROM telemetry"))
def q_stream_bronze(spark, sf):
    return stream_runs.bronze(spark, sf).select("arrival_seq", "event_id", "device_id", "event_timestamp",
                                                 "temperature", "pressure", "vibration", "rpm", "status")


@register("stream_refined", oracle.sql(f"SELECT {REFINED_ORACLE_COLS} FROM refined"))
def q_stream_refined(spark, sf):
    ref, _ = stream_runs.refined(spark, sf)
    return ref.drop("ingestion_timestamp", "processing_timestamp", "batch_id", "event_date")


@register("stream_current_status", oracle.sql(
    "SELECT device_id, last_event_id, last_event_timestamp, temperature, pressure, vibration, rpm, machine_status,"
    " anomaly_level FROM current_status"))
def q_stream_current_status(spark, sf):
    _, writer = stream_runs.refined(spark, sf)
    from vigil.streaming import medallion
    return medallion.read_current_status(spark, writer.status_path).drop("last_arrival_seq")


@register("stream_refined_indexed", oracle.sql(f"SELECT {REFINED_ORACLE_COLS} FROM refined"))
def q_stream_refined_indexed(spark, sf):
    """Exact dedup over eight uneven pieces with readings sent again: a batch reads the buckets of its own ids alone."""
    writer = stream_runs.refined_indexed(spark, sf)
    return spark.read.parquet(writer.refined_path).select(*REFINED_COLUMNS)


@register("current_status_mor", ORACLES["current_status_merge"])
def q_current_status_mor(spark, sf):
    """The status table of the same run: each batch writes its own devices, runs are merged when read."""
    return stream_runs.refined_indexed(spark, sf).status.read(spark).drop("last_arrival_seq")


@register("stream_dedup", oracle.sql("SELECT DISTINCT event_id FROM valid"))
def q_stream_dedup(spark, sf):
    return stream_runs.dedup(spark, sf).select("event_id")


@register("stream_alerts", oracle.sql(ALERTS_SQL, NORM))
def q_stream_alerts(spark, sf):
    return consumers.flat_alerts(stream_runs.alerts(spark, sf))


@register("stream_metrics", oracle.sql(f"SELECT * FROM ({DEVICE_METRICS_SQL}) JOIN ({STATUSES_SQL}) USING (device_id)", NORM))
def q_stream_metrics(spark, sf):
    devices, _ = stream_runs.metrics(spark, sf)
    return _statuses(devices)


@register("stream_fleet", oracle.sql("SELECT COUNT(*) AS total_processed_events, COUNT(DISTINCT device_id) AS total_active_devices FROM norm", NORM))
def q_stream_fleet(spark, sf):
    return stream_runs.metrics(spark, sf)[1].drop("generated_at")


@register("stream_dlq", oracle.sql(
    "SELECT 'reason' AS kind, error_reason AS name, COUNT(*) AS n FROM dlqn GROUP BY error_reason"
    " UNION ALL SELECT 'device', device_id, COUNT(*) FROM dlqn GROUP BY device_id"
    " UNION ALL SELECT 'total', 'all', COUNT(*) FROM dlqn", DLQN))
def q_stream_dlq(spark, sf):
    by_reason, by_device, summary = stream_runs.dlq(spark, sf)
    return (by_reason.selectExpr("'reason' AS kind", "error_reason AS name", "n")
            .union(by_device.selectExpr("'device'", "device_id", "n")).union(summary.selectExpr("'total'", "'all'", "total_quarantined_events")))


@register("maintenance_latch", oracle.sql(
    "SELECT arrival_seq, device_id, MAX(CASE WHEN acc >= 20 OR hot >= 20 OR failures > 0 THEN 1 ELSE 0 END) OVER"
    " (PARTITION BY device_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS maintenance_required"
    " FROM mstate", RAW_MAINT))
def q_maintenance_latch(spark, sf):
    """Maintenance over the raw topic, where vibration falls too: once required, it stays required."""
    state = consumers.maintenance_state(_falling(tel.telemetry(spark, sf)), consumers.WearLimits(max_accumulated_vibration=20.0))
    return state.select("arrival_seq", "device_id", "maintenance_required")


@register("stream_archive", oracle.sql(
    "SELECT arrival_seq, event_id, " + ", ".join(
        f"strftime({ARCHIVE_DAY}, '{f}') AS {n}" for f, n in (("%Y", "year"), ("%m", "month"), ("%d", "day")))
    + " FROM telemetry"))
def q_stream_archive(spark, sf):
    return stream_runs.archive(spark, sf).select("raw_payload.arrival_seq", "raw_payload.event_id", "year", "month",
                                                 "day")


@register("stream_maintenance", oracle.sql(LIFE_SQL, MAINT))
def q_stream_maintenance(spark, sf):
    return stream_runs.maintenance(spark, sf).withColumn("maintenance_reasons",
                                                         text.joined(F.col("maintenance_reasons")))


@register("stream_maintenance_state", ORACLES["lifecycle_by_device"])
def q_stream_maintenance_state(spark, sf):
    """The same from a state store, over six uneven pieces and as many restarts."""
    life = wear.wear_view(stream_runs.maintenance_state(spark, sf).read(spark))
    return life.withColumn("maintenance_reasons", text.joined(F.col("maintenance_reasons")))


@register("stream_work_orders", ORACLES["work_orders"])
def q_stream_work_orders(spark, sf):
    """The work orders that the state store latched."""
    return _flat_orders(wear.wear_orders(stream_runs.maintenance_state(spark, sf).read(spark)))


@register("stream_dlq_records", ORACLES["dlq_records"])
def q_stream_dlq_records(spark, sf):
    """Numbers that go on over five uneven pieces."""
    return stream_runs.dead_letters(spark, sf).read(spark, "records").drop("processed_at")


@register("stream_dlq_alarms", ORACLES["dlq_alarms"])
def q_stream_dlq_alarms(spark, sf):
    """One alarm per reason, at the record that reaches the threshold, in whichever piece it is."""
    return stream_runs.dead_letters(spark, sf).read(spark, "alarms")


@register("stream_running_metrics", ORACLES["running_metrics"])
def q_stream_running_metrics(spark, sf):
    return stream_runs.running_metrics(spark, sf)


@register("stream_moving_avg", ORACLES["moving_avg"])
def q_stream_moving_avg(spark, sf):
    return stream_runs.moving_avg(spark, sf)


# Four pieces in arrival order, a run each: a reading is late if its window had ended by the latest time of the pieces
# before its own, less the delay. The last run's closing batch gives the windows that ended by then.
LATE_SQL = """
SELECT ws AS window_start, ws + INTERVAL '1 hour' AS window_end, device_id, COUNT(*) AS n
FROM (SELECT r.*, b.seen FROM
        (SELECT device_id, t, time_bucket(INTERVAL '1 hour', t) AS ws, piece FROM pieces WHERE t IS NOT NULL) r
        JOIN (SELECT piece, MAX(MAX(t)) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM pieces GROUP BY piece) b USING (piece))
WHERE seen IS NULL OR ws + INTERVAL '1 hour' > seen - INTERVAL '10 minutes'
GROUP BY ws, device_id
HAVING ws + INTERVAL '1 hour' <= (SELECT max(t) FROM pieces) - INTERVAL '10 minutes'"""

PIECES = """
pieces AS (
  SELECT arrival_seq, device_id, try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS t,
         arrival_seq * 4 // ((SELECT MAX(arrival_seq) FROM telemetry) + 1) AS piece
  FROM telemetry
)"""


@register("stream_late_drop", oracle.sql(LATE_SQL, PIECES))
def q_stream_late_drop(spark, sf):
    return stream_runs.late_drop(spark, sf)


@register("stream_late_rows", oracle.sql("""
SELECT arrival_seq, device_id, t AS event_ts, seen - INTERVAL '10 minutes' AS watermark
FROM pieces JOIN (SELECT piece, MAX(MAX(t)) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM pieces GROUP BY piece) b USING (piece)
WHERE time_bucket(INTERVAL '1 hour', t) + INTERVAL '1 hour' <= seen - INTERVAL '10 minutes'""", PIECES))
def q_stream_late_rows(spark, sf):
    """The readings that stream_late_drop loses, one by one."""
    return stream_runs.late_rows(spark, sf).read(spark, "late").select("arrival_seq", "device_id", "event_ts", "watermark")


@register("archive_partition_counts", oracle.sql(
    "SELECT " + ", ".join(f"strftime({ARCHIVE_DAY}, '{f}') AS {n}" for f, n in
                          (("%Y", "year"), ("%m", "month"), ("%d", "day")))
    + ", COUNT(*) AS archived_events FROM telemetry GROUP BY ALL"))
def q_archive_partition_counts(spark, sf):
    return consumers.archive_partition_counts(stream_runs.archive_batch_roundtrip(spark, sf))


# one message in 211 breaks off: it has no fields, and the day it is archived on is its day
BROKEN_DAY = f"CASE WHEN arrival_seq % 211 = 0 THEN CAST(timezone('UTC', current_timestamp) AS TIMESTAMP) ELSE {ARCHIVE_DAY} END"


@register("stream_archive_packed", oracle.sql(
    "SELECT arrival_seq, CASE WHEN arrival_seq % 211 <> 0 THEN event_id END AS event_id, "
    + ", ".join(f"strftime({BROKEN_DAY}, '{f}') AS {n}" for f, n in (("%Y", "year"), ("%m", "month"), ("%d", "day"))) + " FROM telemetry"))
def q_stream_archive_packed(spark, sf):
    """The archive of eight micro-batches, its small files packed twice on the way."""
    return stream_runs.packed_archive(spark, sf).read(spark).select("raw_payload.arrival_seq", "raw_payload.event_id", "year", "month", "day")


@register("archive_unknown_fields", oracle.sql("""
SELECT 'machine' AS field, 'OBJECT<' || CASE WHEN json_extract_string(props, '$.k') IS NULL THEN '' ELSE 'k: BIGINT, ' END || 'kind: STRING>' AS kind, COUNT(*) AS n
FROM events WHERE event_id % 211 <> 0 GROUP BY ALL
UNION ALL SELECT 'firmware', 'STRING', COUNT(*) FROM events WHERE event_id % 211 <> 0 AND event_id % 31 = 0 HAVING COUNT(*) > 0"""))
def q_archive_unknown_fields(spark, sf):
    """Fields of the archived messages that the event schema does not name."""
    return archives.field_summary(stream_runs.packed_archive(spark, sf).read(spark))


@register("archive_malformed", oracle.sql("SELECT arrival_seq FROM telemetry WHERE arrival_seq % 211 = 0"))
def q_archive_malformed(spark, sf):
    return archives.malformed(stream_runs.packed_archive(spark, sf).read(spark)).select("raw_payload.arrival_seq")


@register("archive_machine_kinds", oracle.sql("""
SELECT event_type AS kind, COUNT(*) AS messages, CAST(SUM(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total_k
FROM events WHERE event_id % 211 <> 0 GROUP BY event_type"""))
def q_archive_machine_kinds(spark, sf):
    """A query over a nested field that no schema names."""
    fields = archives.payloads(stream_runs.packed_archive(spark, sf).read(spark)).where("payload IS NOT NULL")
    return fields.selectExpr("try_variant_get(payload, '$.machine.kind', 'string') AS kind", "try_variant_get(payload, '$.machine.k', 'bigint') AS k").groupBy("kind").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("k").alias("total_k"))


@register("reprocess_archive", oracle.sql(f"SELECT {REFINED_ORACLE_COLS} FROM refined"))
def q_reprocess_archive(spark, sf):
    return stream_runs.reprocess_archive(spark, sf).drop("ingestion_timestamp", "processing_timestamp")


# --- reprocessing after a rule change ---------------------------------------------------------------------------------

NEW_LIMITS = rules.Limits(temperature_min=1.0, temperature_max=300.0, temperature_critical=80.0, vibration_critical=17.0, pressure_alert=4.5)


def _new_rules(sql: str) -> str:
    """An oracle's text under NEW_LIMITS."""
    for old, new in (("temperature < 0 OR temperature > 200", "temperature < 1 OR temperature > 300"), ("temperature > 90", "temperature > 80"),
                     ("vibration > 15", "vibration > 17"), ("pressure > 5", "pressure > 4.5E0")):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


def _delta(spark, sf):
    return reprocess.rules_delta(tel.telemetry(spark, sf), rules.LIMITS, NEW_LIMITS)


@register("reprocess_rules_delta", _new_rules(ORACLES["refined"]))
def q_reprocess_rules_delta(spark, sf):
    """The stored refined table brought to other limits by what changes."""
    return reprocess.refined_after(store.refined_table(spark, sf), _delta(spark, sf))


@register("reprocess_rules_tallies", _new_rules(ORACLES["anomaly_by_device"]))
def q_reprocess_rules_tallies(spark, sf):
    return reprocess.tallies_after(analytics.anomaly_by_device(store.refined_table(spark, sf)), _delta(spark, sf))


@register("reprocess_rules_status", _new_rules(ORACLES["current_status_merge"]))
def q_reprocess_rules_status(spark, sf):
    refined = store.refined_table(spark, sf)
    return reprocess.status_after(latest.merge_snapshot(None, refined), refined, _delta(spark, sf)).drop("last_arrival_seq")


@register("reprocess_quarantine", _new_rules(oracle.sql(
    f"SELECT {REFINED_ORACLE_COLS} FROM refined WHERE arrival_seq IN (SELECT arrival_seq FROM quarantine_before)",
    "quarantine_before AS (SELECT arrival_seq FROM telemetry WHERE temperature > 2E2)")))
def q_reprocess_quarantine(spark, sf):
    """Rejects that other limits let through, taken in again from the payload as it was received."""
    return stream_runs.reprocess_quarantine(spark, store.quarantine_table(spark, sf), NEW_LIMITS).drop("ingestion_timestamp", "processing_timestamp")


@register("dlq_scan_json", oracle.sql("SELECT error_reason, COUNT(*) AS n FROM dlqn GROUP BY error_reason", DLQN))
def q_dlq_scan_json(spark, sf):
    return consumers.dlq_by_reason(stream_runs.quarantine_json_scan(spark, sf))


@register("stream_dlq_scan", ORACLES["dlq_scan_json"])
def q_stream_dlq_scan(spark, sf):
    """Counted as the files arrive, a file that is moved meanwhile once."""
    return stream_runs.dlq_scan_arriving(spark, sf).reasons.read(spark)


# --- the serving queries through Spark SQL: views over the stored tables --------------------------------------------

def _serving(name: str):
    def run(spark, sf):
        ref = store.refined_table(spark, sf)
        serving.register_views(ref, latest.current_status(ref))
        return spark.sql(f"SELECT * FROM {name}")
    return run


for _name in serving.VIEWS:
    register(f"sql_{_name}", ORACLES[_name])(_serving(_name))


@register("sql_hot_days", oracle.sql(
    "SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(*) AS readings, MAX(temperature) AS hottest FROM refined"
    " WHERE anomaly_level <> 'NORMAL' GROUP BY 1"))
def q_sql_hot_days(spark, sf):
    ref = store.refined_table(spark, sf)
    serving.register_views(ref, latest.current_status(ref))
    return spark.sql(f"SELECT event_date, COUNT(*) AS readings, MAX(temperature) AS hottest FROM {serving.MEASUREMENTS}"
                     " WHERE anomaly_level <> 'NORMAL' GROUP BY event_date")
