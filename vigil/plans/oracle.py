"""DuckDB oracle texts: an independent SQL formulation of every registered query.

Each oracle is one statement ``WITH <base CTEs> SELECT ...`` over the pre-registered ``events`` view. The base CTEs
restate the telemetry projection, the eight rules, keep-first dedup and severity in plain SQL (no shared code with
the Spark side beyond the fixed values). Timestamps are naive UTC; wall-clock columns are never compared.
"""

from __future__ import annotations

TELEMETRY = """
telemetry AS (
  SELECT event_id AS arrival_seq,
    CONCAT('evt-', CAST(CASE WHEN event_id % 40 = 39 THEN event_id - 1 ELSE event_id END AS VARCHAR)) AS event_id,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE CONCAT('MTR-', printf('%04d', user_id)) END AS device_id,
    strftime(CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 50 = 7 THEN ts - INTERVAL '12' HOUR ELSE ts END,
             '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
    value AS temperature,
    CASE WHEN event_id % 83 = 0 THEN -1.0E0
         ELSE CAST(CAST(json_extract_string(props, '$.k') AS INT) * 8 AS DOUBLE) / 1.0E2 END AS pressure,
    CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 1.6E1 + CAST(event_id % 9 AS DOUBLE)
         ELSE CAST((event_id * 37) % 700 AS DOUBLE) / 1.0E2 END AS vibration,
    CAST(CASE WHEN event_id % 89 = 0 THEN -1 ELSE 1400 + (event_id * 13) % 400 END AS INT) AS rpm,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'EXPLODED'
         WHEN event_type = 'error' AND event_id % 20 = 0 THEN 'FAILURE' WHEN event_type = 'error' THEN 'MAINTENANCE'
         WHEN event_type = 'signup' THEN 'STOPPED' ELSE 'RUNNING' END AS status
  FROM events
)"""

DQ = """
dq AS (
  SELECT *, NULLIF(CONCAT_WS(', ',
      CASE WHEN event_id IS NULL OR event_id = '' THEN 'event_id_null' END,
      CASE WHEN device_id IS NULL OR device_id = '' THEN 'device_id_null' END,
      CASE WHEN event_timestamp IS NULL OR event_timestamp = '' THEN 'event_timestamp_null' END,
      CASE WHEN event_timestamp <> '' AND TRY_CAST(event_timestamp AS TIMESTAMPTZ) IS NULL
           THEN 'event_timestamp_invalid' END,
      CASE WHEN temperature IS NULL OR isnan(temperature) OR temperature < 0 OR temperature > 200
           THEN 'temperature_out_of_range' END,
      CASE WHEN pressure IS NULL OR isnan(pressure) OR pressure < 0 THEN 'pressure_negative' END,
      CASE WHEN vibration IS NULL OR isnan(vibration) OR vibration < 0 THEN 'vibration_negative' END,
      CASE WHEN rpm IS NULL OR rpm < 0 THEN 'rpm_negative' END,
      CASE WHEN status IS NULL OR status NOT IN ('RUNNING', 'STOPPED', 'MAINTENANCE', 'FAILURE')
           THEN 'invalid_status' END), '') AS error_reason
  FROM telemetry
)"""

REFINED = """
valid AS (SELECT * FROM dq WHERE error_reason IS NULL),
firsts AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS rn FROM valid
),
refined AS (
  SELECT arrival_seq, event_id, device_id,
    CAST(strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS TIMESTAMP) AS event_timestamp,
    temperature, pressure, vibration, rpm, status AS machine_status,
    CASE WHEN temperature > 90 OR vibration > 15 OR pressure > 7 THEN 'CRITICAL'
         WHEN temperature > 75 OR vibration > 6 OR pressure > 5 THEN 'WARNING' ELSE 'NORMAL' END AS anomaly_level,
    temperature > 75 AS temperature_alert, pressure > 5 AS pressure_alert, vibration > 6 AS vibration_alert
  FROM firsts WHERE rn = 1
),
quarantine AS (SELECT arrival_seq, event_id, device_id, error_reason FROM dq WHERE error_reason IS NOT NULL),
current_status AS (
  SELECT device_id, event_id AS last_event_id, event_timestamp AS last_event_timestamp, temperature, pressure,
         vibration, rpm, machine_status, anomaly_level
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, arrival_seq DESC) AS r
        FROM refined) WHERE r = 1
)"""


def sql(select: str, extra_ctes: str = "") -> str:
    ctes = ",".join([TELEMETRY, DQ, REFINED])
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{select}"
