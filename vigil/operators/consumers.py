"""The five downstream consumers as DataFrame operators (batch, and streaming where the operator is legal there).

alerts       stateless filter + projection (critical readings -> alert records)
metrics      per-device aggregates (partial + final hash aggregation; skew-safe) and the running form (prefix scan)
archive      raw envelope + UTC date partition columns for a ``partitionBy(year, month, day)`` sink
dlq          quarantine statistics: by reason string, by single code, by device, rates, threshold alarms
maintenance  running wear state, health score, latched first work order per device, life-cycle summary

Inputs are any frame with the telemetry columns; missing metrics count as 0.0, missing keys as ``UNKNOWN``
(the consumers' own defaults). Expressions are SQL text: one JVM call each while the plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import exact, rules, text
from vigil.operators import scan

# --- fixed values that must equal the source system's -------------------------------------------------
UNKNOWN = "UNKNOWN"
UNKNOWN_DEVICE = "UNKNOWN_DEVICE"
UNSPECIFIED_ERROR = "unspecified_error"
MISSING_EVENT_ID = "N/A"
ALERT_FLAGGED = "Anomaly Level CRITICAL Flagged"
ALERT_FAILURE = "Machine Status FAILURE"
FAILURE = "FAILURE"
RUNNING = "RUNNING"
DEFAULT_TOPIC = "iot-machine-events"
DLQ_ALARM_THRESHOLD = 10
MSG_FAILURE = "Catastrophic Machine Failure Detected"
MSG_TEMPERATURE = "Temperature CRITICAL ({value}°C > {limit}°C)"
MSG_VIBRATION = "Vibration CRITICAL ({value} mm/s > {limit} mm/s)"
MSG_PRESSURE = "Pressure CRITICAL ({value} bar > {limit} bar)"
MSG_WEAR_VIBRATION = "Excessive Accumulated Vibration ({value} >= {limit})"
MSG_WEAR_HEAT = "High Temperature Operating Limit ({value} >= {limit} cycles)"
# -------------------------------------------------------------------------------------------------------

_METRICS = ("temperature", "pressure", "vibration")


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _message(value: str, limit: str, words: str) -> str:
    """SQL: a message with its value (an expression) and limit put in."""
    before, after = words.format(value="\0", limit=limit).split("\0")
    return f"concat({_q(before)}, {value}, {_q(after)})"


def normalize(df: DataFrame) -> DataFrame:
    """Consumer-side coercion: NULL metrics -> 0.0, NULL device/status -> UNKNOWN, status upper-cased."""
    cols = set(df.columns)
    status_src = "machine_status" if "machine_status" in cols and "status" not in cols else "status"
    level = "anomaly_level" if "anomaly_level" in cols else "CAST(NULL AS STRING)"
    new = {m: F.expr(f"coalesce(CAST({m} AS DOUBLE), 0.0D)") for m in _METRICS}
    new.update({
        "status": F.expr(f"upper(coalesce({status_src}, {_q(UNKNOWN)}))"),
        "device_id": F.expr(f"coalesce(device_id, {_q(UNKNOWN)})"),
        "event_id": F.expr(f"coalesce(event_id, {_q(MISSING_EVENT_ID)})"),
        "anomaly_level": F.expr(f"upper(coalesce({level}, ''))"),
    })
    return df.withColumns(new)


# --- alerts ----------------------------------------------------------------------------------------------------

def critical_sql(limits: rules.Limits = rules.LIMITS) -> str:
    n = text.fnum
    return (f"(temperature > {n(limits.temperature_critical)}D OR vibration > {n(limits.vibration_critical)}D "
            f"OR pressure > {n(limits.pressure_critical)}D OR status = {_q(FAILURE)} "
            f"OR anomaly_level = {_q(rules.CRITICAL)})")


def alert_reasons_sql(limits: rules.Limits = rules.LIMITS) -> str:
    over = [("temperature", limits.temperature_critical, MSG_TEMPERATURE), ("vibration", limits.vibration_critical, MSG_VIBRATION),
            ("pressure", limits.pressure_critical, MSG_PRESSURE)]
    parts = [(f"{c} > {text.fnum(limit)}D", _message(text.num_sql(c), text.fnum(limit), words)) for c, limit, words in over]
    found = text.reason_list_sql([*parts, (f"status = {_q(FAILURE)}", _q(ALERT_FAILURE))])
    return f"CASE WHEN size({found}) > 0 THEN {found} ELSE array({_q(ALERT_FLAGGED)}) END"


def alerts(df: DataFrame, limits: rules.Limits = rules.LIMITS) -> DataFrame:
    """Alert records for critical readings (works on streaming frames: no state)."""
    keep = [c for c in ("arrival_seq",) if c in df.columns]
    unnamed = ", ".join(f"CAST({c} AS STRING)" for c in ("device_id", "event_timestamp", *keep))
    norm = normalize(df.withColumn("_alert_key", F.expr(f"coalesce(event_id, concat_ws('|', {unnamed}))")))
    return norm.filter(F.expr(critical_sql(limits))).selectExpr(
        *keep,
        f"{text.hash_id_sql('alt-', '_alert_key')} AS alert_id",
        "device_id", "event_id", f"{_q(rules.CRITICAL)} AS severity", f"{alert_reasons_sql(limits)} AS reasons",
        "named_struct('temperature', temperature, 'pressure', pressure, 'vibration', vibration, 'status', status)"
        " AS metrics",
        "event_timestamp", "current_timestamp() AS alert_timestamp")


def flat_alerts(alert_df: DataFrame) -> DataFrame:
    return alert_df.selectExpr("alert_id", "device_id", "event_id", "severity",
                               "concat_ws('; ', reasons) AS reasons", "metrics.temperature", "metrics.pressure",
                               "metrics.vibration", "metrics.status", "event_timestamp")


# --- metrics ---------------------------------------------------------------------------------------------------

def _metric_aggs(order: str) -> list:
    aggs = ["count(1) AS total_events"]
    for m in _METRICS:
        aggs += [f"{exact.sum_hundredths_sql(m)} AS _s_{m}", f"min({m}) AS min_{m}", f"max({m}) AS max_{m}"]
    aggs.append(f"max_by(event_timestamp, {order}) AS last_event_timestamp")
    return [F.expr(a) for a in aggs]


def _metric_view(extra_first: list[str]) -> list[str]:
    out = list(extra_first) + ["total_events"]
    for m in _METRICS:
        out += [f"{exact.half_up_avg2_sql(f'_s_{m}', 'total_events')} AS avg_{m}", f"min_{m}", f"max_{m}"]
    return out


def device_metrics(df: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Final per-device summary: count, exact avg (2 dp HALF_UP), min, max, last event time by arrival."""
    g = normalize(df).groupBy("device_id").agg(*_metric_aggs(order))
    return g.selectExpr(*_metric_view(["device_id"]), "last_event_timestamp", "current_timestamp() AS updated_at")


def status_distribution(df: DataFrame, nested: bool = False) -> DataFrame:
    """(device, status, n); ``nested=True``: one row per device with ``map<status, n>``.

    Two-level aggregation: the map is built from at most one entry per distinct status of a device."""
    flat = normalize(df).groupBy("device_id", "status").agg(F.expr("count(1) AS n"))
    if not nested:
        return flat
    return flat.groupBy("device_id").agg(
        F.expr("map_from_entries(collect_list(struct(status, n))) AS status_distribution"))


def metrics_by_status(df: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """The metrics' partial form, one row per (device, status): legal on a stream in complete mode."""
    return normalize(df).groupBy("device_id", "status").agg(*_metric_aggs(order), F.expr(f"max({order}) AS _last"))


def metrics_snapshot(by_status: DataFrame) -> DataFrame:
    """Per device, from ``metrics_by_status``: the summary and the map of its readings by status."""
    parts = [f"{'sum' if c[:2] == '_s' else c[:3]}({c}) AS {c}" for m in _METRICS for c in (f"_s_{m}", f"min_{m}", f"max_{m}")]
    g = by_status.groupBy("device_id").agg(
        F.expr("map_from_entries(collect_list(struct(status, total_events))) AS status_distribution"),
        F.expr("sum(total_events) AS total_events"), *map(F.expr, parts), F.expr("max_by(last_event_timestamp, _last) AS last_event_timestamp"))
    return g.selectExpr(*_metric_view(["device_id"]), "last_event_timestamp", "status_distribution")


def fleet_of(snapshot: DataFrame) -> DataFrame:
    """The fleet's totals from a metrics snapshot."""
    return snapshot.agg(F.expr("coalesce(sum(total_events), 0) AS total_processed_events"), F.expr("count(1) AS total_active_devices"),
                        F.expr("current_timestamp() AS generated_at"))


def fleet_summary(df: DataFrame) -> DataFrame:
    return normalize(df).agg(F.expr("count(1) AS total_processed_events"),
                             F.expr("count(DISTINCT device_id) AS total_active_devices"),
                             F.expr("current_timestamp() AS generated_at"))


def running_totals(df: DataFrame, order: str = "arrival_seq", span: int | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Count, sums and extremes after each reading, per device, in arrival order (skew-proof prefix scan). ``prior``
    (streaming): rows of these totals by device, of all readings before ``df``."""
    aggs = {"total_events": ("sum", "CAST(1 AS BIGINT)")}
    for m in _METRICS:
        aggs[f"_s_{m}"] = ("sum", exact.hundredths_sql(m))
        aggs[f"min_{m}"] = ("min", m)
        aggs[f"max_{m}"] = ("max", m)
    r = scan.running(normalize(df), "device_id", order, aggs, span=span).select(order, "device_id", *aggs)
    if prior is None:
        return r
    joined = r.join(prior.select("device_id", *[F.col(c).alias(f"_p{c}") for c in aggs]), "device_id", "left")
    both = {"sum": "{0} + coalesce(_p{0}, 0)", "min": "least({0}, _p{0})", "max": "greatest({0}, _p{0})"}
    return joined.select(order, "device_id", *[F.expr(both[kind].format(c)).alias(c) for c, (kind, _) in aggs.items()])


def running_view(totals: DataFrame, order: str = "arrival_seq") -> DataFrame:
    return totals.selectExpr(*_metric_view([order, "device_id"]))


def running_metrics(df: DataFrame, order: str = "arrival_seq", span: int | None = None) -> DataFrame:
    """The summary after each reading, per device, in arrival order."""
    return running_view(running_totals(df, order, span), order)


# --- archive ---------------------------------------------------------------------------------------------------

def with_date_parts(df: DataFrame, ts: str, fallback: str | None = None) -> DataFrame:
    """Zero-padded ``year``/``month``/``day`` strings of the UTC calendar day; ``fallback`` when ts is NULL."""
    t = f"to_utc_timestamp(coalesce({ts}, {fallback or 'current_timestamp()'}), current_timezone())"
    return df.withColumns({"year": F.expr(f"date_format({t}, 'yyyy')"), "month": F.expr(f"date_format({t}, 'MM')"),
                           "day": F.expr(f"date_format({t}, 'dd')")})


def archive_records(df: DataFrame, topic: str = DEFAULT_TOPIC, fallback: str | None = None) -> DataFrame:
    """Envelope ``_ingested_at, _source_topic, raw_text, raw_payload`` + partition columns. ``raw_text`` is the message
    as received where the frame has it (``value``), else the reading as JSON; unknown fields and malformed messages
    are in it whole."""
    payload_cols = [c for c in df.columns if c not in ("value", "kafka_timestamp", "ingestion_timestamp")]
    raw = "CAST(value AS STRING)" if "value" in df.columns else f"to_json(struct({', '.join(payload_cols)}))"
    parsed = (rules.parsed_time_sql("event_timestamp") if dict(df.dtypes)["event_timestamp"] == "string"
              else "CAST(event_timestamp AS TIMESTAMP)")
    out = df.selectExpr("current_timestamp() AS _ingested_at", f"{_q(topic)} AS _source_topic", f"{raw} AS raw_text",
                        f"struct({', '.join(payload_cols)}) AS raw_payload", f"{parsed} AS _ts")
    return with_date_parts(out, "_ts", fallback).drop("_ts")


def archive_partition_counts(archive: DataFrame) -> DataFrame:
    return archive.groupBy("year", "month", "day").agg(F.expr("count(1) AS archived_events"))


# --- dead-letter statistics ------------------------------------------------------------------------------------

def _device_or_unknown(c: str = "device_id") -> str:
    return f"coalesce(nullif({c}, ''), {_q(UNKNOWN_DEVICE)})"


def dlq_normalize(q: DataFrame) -> DataFrame:
    return q.withColumns({
        "device_id": F.expr(_device_or_unknown()),
        "error_reason": F.expr(f"coalesce(nullif(error_reason, ''), {_q(UNSPECIFIED_ERROR)})"),
        "event_id": F.expr(f"coalesce(event_id, {_q(MISSING_EVENT_ID)})"),
    })


def dlq_records(q: DataFrame, order: str | list[str] = "arrival_seq", span: int | None = None, first: int = 1) -> DataFrame:
    """``dlq-<n>``: n = position, from ``first``, in arrival order over the whole quarantine, computed by a chunked prefix count
    (no single-partition global window). Offsets of several topic partitions tie: give a total order then, e.g.
    ``["kafka_timestamp", "kafka_partition", "arrival_seq"]``."""
    seq = scan.sequence(dlq_normalize(q), None, order, "_n", span=span)
    return seq.selectExpr(*([order] if isinstance(order, str) else order), f"concat('dlq-', CAST(_n + {int(first) - 1} AS STRING)) AS quarantine_id", "event_id", "device_id",
                          "error_reason", "current_timestamp() AS processed_at")


def dlq_counts(q: DataFrame) -> DataFrame:
    """Rejects per (reason, device): the statistics' partial form, legal on a stream in complete mode."""
    return dlq_normalize(q).groupBy("error_reason", "device_id").agg(F.expr("count(1) AS n"))


def dlq_views(counts: DataFrame) -> dict[str, DataFrame]:
    """The snapshots that ``dlq_counts`` gives."""
    return {
        "by_reason": counts.groupBy("error_reason").agg(F.expr("sum(n) AS n")),
        "by_device": counts.groupBy("device_id").agg(F.expr("sum(n) AS n")),
        "summary": counts.agg(F.expr("coalesce(sum(n), 0) AS total_quarantined_events"), F.expr("count(DISTINCT error_reason) AS distinct_reasons"),
                              F.expr("count(DISTINCT device_id) AS distinct_devices"), F.expr("current_timestamp() AS last_processed_at")),
    }


def dlq_by_reason(q: DataFrame) -> DataFrame:
    return dlq_normalize(q).groupBy("error_reason").agg(F.expr("count(1) AS n"))


def dlq_by_device(q: DataFrame) -> DataFrame:
    return dlq_normalize(q).groupBy("device_id").agg(F.expr("count(1) AS n"))


def dlq_by_code(q: DataFrame) -> DataFrame:
    codes = dlq_normalize(q).selectExpr(f"explode(split(error_reason, {_q(rules.REASON_SEPARATOR)})) AS code")
    return codes.groupBy("code").agg(F.expr("count(1) AS n"))


def dlq_rate_by_device(checked: DataFrame) -> DataFrame:
    """Rejected / all readings per device, both sides counted in one aggregate."""
    g = checked.groupBy(F.expr(_device_or_unknown()).alias("device_id")).agg(
        F.expr("count(1) AS total"), F.expr("count_if(NOT is_valid) AS rejected"))
    return g.withColumn("reject_rate", F.expr("CAST(rejected AS DOUBLE) / CAST(total AS DOUBLE)"))


def dlq_summary(q: DataFrame) -> DataFrame:
    return dlq_normalize(q).agg(F.expr("count(1) AS total_quarantined_events"),
                                F.expr("count(DISTINCT error_reason) AS distinct_reasons"),
                                F.expr("count(DISTINCT device_id) AS distinct_devices"),
                                F.expr("current_timestamp() AS last_processed_at"))


def dlq_threshold(q: DataFrame, n: int = DLQ_ALARM_THRESHOLD) -> DataFrame:
    """Reasons whose count reached the alarm threshold."""
    return dlq_by_reason(q).filter(F.expr(f"n >= {int(n)}"))


def dlq_alarms(q: DataFrame, n: int = DLQ_ALARM_THRESHOLD, order: str | list[str] = "arrival_seq",
               span: int | None = None) -> DataFrame:
    """The quarantined record at which each reason's count reaches the threshold (when the alarm fires).
    Per-reason arrival numbers come from the chunked prefix scan, so a reason holding most rejects is not
    numbered in one task."""
    seq = scan.sequence(dlq_normalize(q), "error_reason", order, "_n", span=span)
    return seq.filter(F.expr(f"_n = {int(n)}")).selectExpr(
        "error_reason", f"{order if isinstance(order, str) else order[-1]} AS alarm_at", "event_id", "device_id")


# --- maintenance -----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class WearLimits:
    """Maintenance limits (fixed defaults: accumulated vibration 100.0, 20 high-temperature cycles)."""

    max_accumulated_vibration: float = 100.0
    max_high_temp_cycles: int = 20
    hot_temperature: float = 75.0
    high_pressure: float = 5.0


WEAR = WearLimits()


def _factor(limit) -> str:
    return f"CAST({Decimal(50) / Decimal(str(limit))} AS DECIMAL(20,10))"


def health_score_sql(acc: str = "_acc", hot: str = "high_temp_cycles", lim: WearLimits = WEAR) -> str:
    """``max(0, round(100 - min(50, acc/maxv*50) - min(50, hot/maxh*50), 1))`` in exact decimals."""
    vib_pen = f"least(CAST(50 AS DECIMAL(20,10)), CAST({acc} AS DECIMAL(28,2)) * {_factor(lim.max_accumulated_vibration)})"
    hot_pen = f"least(CAST(50 AS DECIMAL(20,10)), CAST({hot} AS DECIMAL(20,0)) * {_factor(lim.max_high_temp_cycles)})"
    return (f"CAST(greatest(CAST(0 AS DECIMAL(20,1)), round(CAST(100 AS DECIMAL(20,10)) - {vib_pen} - {hot_pen}, 1))"
            " AS DOUBLE)")


def maintenance_reasons_sql(acc: str = "_acc", hot: str = "high_temp_cycles", status: str = "status",
                            lim: WearLimits = WEAR) -> str:
    v, h = text.fnum(lim.max_accumulated_vibration), int(lim.max_high_temp_cycles)
    return text.reason_list_sql([
        (f"{acc} >= {v}D", _message(text.num_sql(acc), v, MSG_WEAR_VIBRATION)),
        (f"{hot} >= {h}", _message(f"CAST({hot} AS STRING)", str(h), MSG_WEAR_HEAT)),
        (f"{status} = {_q(FAILURE)}", _q(MSG_FAILURE)),
    ])


# running totals carried between micro-batches
SNAPSHOT_TOTALS = ["total_cycles", "running_cycles", "_acc", "high_temp_cycles", "high_pressure_cycles", "_failures"]


def maintenance_state(df: DataFrame, lim: WearLimits = WEAR, order: str = "arrival_seq",
                      span: int | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Wear state after each reading, per device, in arrival order.

    One skew-proof prefix scan computes every running quantity, including the number of FAILURE readings so far.
    Hot cycles and failures never decrease. Accumulated vibration may (raw readings can be negative), so its running
    peak is scanned too: once a limit was reached, "a work order exists" stays true whatever follows.

    ``prior`` (streaming): a per-device snapshot (see ``maintenance_snapshot``) whose totals are carried into the
    running values of this batch -- the same result as one pass over all batches.
    """
    aggs = {
        "total_cycles": ("sum", "CAST(1 AS BIGINT)"),
        "running_cycles": ("sum", f"CAST(status = {_q(RUNNING)} AS BIGINT)"),
        "_acc": ("sum", "CAST(vibration AS DECIMAL(18,2))"),
        "_peak": ("peak", "CAST(vibration AS DECIMAL(18,2))"),
        "high_temp_cycles": ("sum", f"CAST(temperature > {text.fnum(lim.hot_temperature)}D AS BIGINT)"),
        "high_pressure_cycles": ("sum", f"CAST(pressure > {text.fnum(lim.high_pressure)}D AS BIGINT)"),
        "_failures": ("sum", f"CAST(status = {_q(FAILURE)} AS BIGINT)"),
    }
    r = scan.running(normalize(df), "device_id", order, aggs, span=span)
    if prior is not None:
        p = prior.selectExpr("device_id", "_peak AS _p_peak", *[f"{c} AS _p{c}" for c in SNAPSHOT_TOTALS])
        r = r.join(p, "device_id", "left")
        r = r.withColumns({c: F.expr(f"{c} + coalesce(_p{c}, 0)") for c in SNAPSHOT_TOTALS} | {"_peak": F.expr("greatest(_peak + coalesce(_p_acc, 0), _p_peak)")})
        r = r.drop("_p_peak", *[f"_p{c}" for c in SNAPSHOT_TOTALS])
    required = (f"(_peak >= {text.fnum(lim.max_accumulated_vibration)}D OR high_temp_cycles >= "
                f"{int(lim.max_high_temp_cycles)} OR _failures > 0)")
    return r.selectExpr(order, "device_id", "event_id", "status AS last_status", "total_cycles", "running_cycles",
                        "CAST(_acc AS DOUBLE) AS accumulated_vibration", "high_temp_cycles", "high_pressure_cycles",
                        f"{health_score_sql(lim=lim)} AS health_score",
                        f"{maintenance_reasons_sql(lim=lim)} AS reasons", f"{required} AS maintenance_required",
                        "_acc", "_peak", "_failures")


def maintenance_snapshot(state: DataFrame, prior: DataFrame | None, new_orders: DataFrame,
                         order: str = "arrival_seq", lim: WearLimits = WEAR) -> DataFrame:
    """Next per-device snapshot: the last state row of each device in this batch (it already includes the prior
    totals), devices untouched by the batch carried over, and the work order latched once."""
    fields = SNAPSHOT_TOTALS + ["_peak", "last_status"]
    last = state.groupBy("device_id").agg(F.expr(f"max_by(struct({', '.join(fields)}), {order}) AS s"))
    cur = last.selectExpr("device_id", *[f"s.{c} AS {c}" for c in fields])
    cur = cur.join(new_orders.selectExpr("device_id", "reasons AS _new_reasons"), "device_id", "left")
    if prior is not None:
        old = prior.selectExpr("device_id", *[f"{c} AS _o{c}" for c in fields + ["maintenance_reasons"]])
        cur = cur.join(old, "device_id", "full_outer")
        cur = cur.withColumns({c: F.expr(f"coalesce({c}, _o{c})") for c in fields})
        reasons = "coalesce(_omaintenance_reasons, _new_reasons)"
    else:
        reasons = "_new_reasons"
    return cur.selectExpr("device_id", *fields, f"{reasons} AS maintenance_reasons")


def _lifecycle_cols(lim: WearLimits) -> list[str]:
    return ["device_id", "total_cycles", "running_cycles", "CAST(_acc AS DOUBLE) AS accumulated_vibration",
            "high_temp_cycles", "high_pressure_cycles", "last_status",
            "maintenance_reasons IS NOT NULL AS maintenance_required",
            "coalesce(maintenance_reasons, CAST(array() AS ARRAY<STRING>)) AS maintenance_reasons",
            f"{health_score_sql(lim=lim)} AS health_score"]


def snapshot_view(snapshot: DataFrame, lim: WearLimits = WEAR) -> DataFrame:
    """The life-cycle-by-device view of a snapshot (same columns as ``lifecycle_by_device``)."""
    return snapshot.selectExpr(*_lifecycle_cols(lim))


def work_orders(state: DataFrame, order: str = "arrival_seq", latched: DataFrame | None = None) -> DataFrame:
    """The first reading per device whose reasons are non-empty (latched): one work order per device.

    ``min_by`` over a keyed aggregate: partial aggregation keeps one candidate per device per mapper.
    ``latched``: devices that already have an order (streaming); they get none."""
    trig = state.filter(F.expr("size(reasons) > 0"))
    if latched is not None:
        trig = trig.join(latched.select("device_id"), "device_id", "left_anti")
    first = trig.groupBy("device_id").agg(F.expr(
        f"min_by(struct({order}, event_id, total_cycles, last_status, health_score, reasons), {order}) AS w"))
    return first.selectExpr(
        "concat('WO-', device_id, '-', CAST(w.total_cycles AS STRING)) AS work_order_id", "device_id",
        "w.event_id AS trigger_event_id",
        f"CASE WHEN w.last_status = {_q(FAILURE)} THEN 'HIGH' ELSE 'MEDIUM' END AS priority",
        "w.health_score AS health_score", "w.reasons AS reasons", "current_timestamp() AS created_at")


def lifecycle_by_device(df: DataFrame, lim: WearLimits = WEAR, order: str = "arrival_seq",
                        span: int | None = None) -> DataFrame:
    """Final wear state per device from one scan and one keyed aggregate: the last state row (``max_by``) and the
    reasons of the first triggering row (``min_by ... FILTER``), i.e. the latched work order."""
    state = maintenance_state(df, lim, order, span)
    fields = SNAPSHOT_TOTALS + ["last_status"]
    g = state.groupBy("device_id").agg(
        F.expr(f"max_by(struct({', '.join(fields)}), {order}) AS s"),
        F.expr(f"min_by(reasons, {order}) FILTER (WHERE size(reasons) > 0) AS maintenance_reasons"))
    snap = g.selectExpr("device_id", *[f"s.{c} AS {c}" for c in fields], "maintenance_reasons")
    return snapshot_view(snap, lim)


def lifecycle_summary(by_device: DataFrame) -> DataFrame:
    return by_device.agg(F.expr("count(1) AS monitored_devices_count"),
                         F.expr("count_if(maintenance_required) AS open_work_orders_count"),
                         F.expr("current_timestamp() AS updated_at"))
