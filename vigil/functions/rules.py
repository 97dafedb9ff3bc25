"""Data-quality rules, alert flags and severity as Spark Column expressions.

The rule table is data: each rule has a code, its failing condition and its positive form, in a fixed order.
``error_reason`` compiles the failing conditions into one column (the failed codes joined by ", ", NULL when valid);
``is_valid`` is the conjunction of the positive forms, which stays small and code-generated when it is pushed into a
scan. Both are never three-valued (a NULL input fails its rule instead of vanishing from both sides), and tests hold
them against each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the source system's -------------------------------------------------
# Accepted machine states.
VALID_STATUSES = ("RUNNING", "STOPPED", "MAINTENANCE", "FAILURE")
# Rule codes, in the order they are reported (joined with ", ").
CODE_EVENT_ID = "event_id_null"
CODE_DEVICE_ID = "device_id_null"
CODE_TIMESTAMP = "event_timestamp_null"
CODE_TEMPERATURE = "temperature_out_of_range"
CODE_PRESSURE = "pressure_negative"
CODE_VIBRATION = "vibration_negative"
CODE_RPM = "rpm_negative"
CODE_STATUS = "invalid_status"
# Codes used by the per-record validator for a missing metric (null_codes=True).
CODE_TEMPERATURE_NULL = "temperature_null"
CODE_PRESSURE_NULL = "pressure_null"
CODE_VIBRATION_NULL = "vibration_null"
CODE_RPM_NULL = "rpm_null"
# Our extension: a timestamp text that is present but cannot be parsed.
CODE_TIMESTAMP_INVALID = "event_timestamp_invalid"
REASON_SEPARATOR = ", "
# Severity labels.
CRITICAL, WARNING, NORMAL = "CRITICAL", "WARNING", "NORMAL"
# -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Limits:
    """Thresholds (fixed values: temperature range 0..200; alert / warning / critical limits)."""

    temperature_min: float = 0.0
    temperature_max: float = 200.0
    temperature_alert: float = 75.0      # alert flag and WARNING
    pressure_alert: float = 5.0
    vibration_alert: float = 6.0
    temperature_critical: float = 90.0   # CRITICAL
    pressure_critical: float = 7.0
    vibration_critical: float = 15.0


LIMITS = Limits()


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


def _num(x: float) -> str:
    return f"{float(x)!r}D"


def parsed_time(c: Column) -> Column:
    """ISO-8601 text (``Z`` or offset, optional fraction) -> timestamp; NULL when unparseable (never throws)."""
    return F.try_to_timestamp(c)


def parsed_time_sql(c: str) -> str:
    return f"try_to_timestamp({c})"


def rule_table(dtypes, limits: Limits = LIMITS, null_codes: bool = False) -> list[tuple[str, str]]:
    """(code, failing condition as SQL) pairs in report order, for a frame with ``dtypes``. Every condition is
    NULL-safe (TRUE or FALSE, never NULL). ``event_timestamp`` may be text (blank and unparseable texts fail) or a
    timestamp (only NULL fails). NaN metrics fail their range rule (NaN sorts above every number in Spark)."""
    types = dict(dtypes)
    rules: list[tuple[str, str]] = [
        (CODE_EVENT_ID, _blank("event_id")),
        (CODE_DEVICE_ID, _blank("device_id")),
    ]
    if types.get("event_timestamp", "string") == "string":
        rules.append((CODE_TIMESTAMP, _blank("event_timestamp")))
        rules.append((CODE_TIMESTAMP_INVALID,
                      f"(NOT {_blank('event_timestamp')} AND {parsed_time_sql('event_timestamp')} IS NULL)"))
    else:
        rules.append((CODE_TIMESTAMP, "(event_timestamp IS NULL)"))

    def metric(name: str, range_code: str, null_code: str, bad: str):
        bad = f"({bad} OR isnan({name}))"
        if null_codes:
            rules.append((null_code, f"({name} IS NULL)"))
            rules.append((range_code, f"({name} IS NOT NULL AND {bad})"))
        else:
            rules.append((range_code, f"({name} IS NULL OR {bad})"))

    metric("temperature", CODE_TEMPERATURE, CODE_TEMPERATURE_NULL,
           f"temperature < {_num(limits.temperature_min)} OR temperature > {_num(limits.temperature_max)}")
    metric("pressure", CODE_PRESSURE, CODE_PRESSURE_NULL, "pressure < 0.0D")
    metric("vibration", CODE_VIBRATION, CODE_VIBRATION_NULL, "vibration < 0.0D")
    if null_codes:
        rules.append((CODE_RPM_NULL, "(rpm IS NULL)"))
        rules.append((CODE_RPM, "(rpm IS NOT NULL AND rpm < 0)"))
    else:
        rules.append((CODE_RPM, "(rpm IS NULL OR rpm < 0)"))
    states = ", ".join(f"'{v}'" for v in VALID_STATUSES)
    rules.append((CODE_STATUS, f"(status IS NULL OR status NOT IN ({states}))"))
    return rules


def error_reason_sql(dtypes, limits: Limits = LIMITS, null_codes: bool = False) -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in rule_table(dtypes, limits, null_codes))
    return f"nullif(concat_ws('{REASON_SEPARATOR}', {parts}), '')"


def error_reason(dtypes, limits: Limits = LIMITS, null_codes: bool = False) -> Column:
    """Failed rule codes joined with ", " in rule order; NULL when the row is valid (``concat_ws`` skips NULLs and
    is fully code-generated)."""
    return F.expr(error_reason_sql(dtypes, limits, null_codes))


def holds_sql(dtypes, limits: Limits = LIMITS) -> list[str]:
    """Each rule in its positive form: TRUE when it holds, FALSE when it fails, NULL when its input is NULL (a NULL
    input fails every rule it feeds). ``coalesce(AND of these, FALSE)`` is exactly ``NOT (any failing condition)``
    but references each input fewer times, which keeps a pushed-down filter small."""
    text_ts = dict(dtypes).get("event_timestamp", "string") == "string"
    states = ", ".join(f"'{v}'" for v in VALID_STATUSES)
    return [
        "event_id <> ''",
        "device_id <> ''",
        f"{parsed_time_sql('event_timestamp')} IS NOT NULL" if text_ts else "event_timestamp IS NOT NULL",
        f"temperature BETWEEN {_num(limits.temperature_min)} AND {_num(limits.temperature_max)}",  # NaN is above all
        "pressure >= 0.0D AND NOT isnan(pressure)",
        "vibration >= 0.0D AND NOT isnan(vibration)",
        "rpm >= 0",
        f"status IN ({states})",
    ]


def passes_sql(dtypes, limits: Limits = LIMITS) -> str:
    return "coalesce(" + " AND ".join(f"({h})" for h in holds_sql(dtypes, limits)) + ", false)"


def passes(dtypes, limits: Limits = LIMITS) -> Column:
    """TRUE when no rule fails (never NULL). A plain boolean expression, so a filter on it stays small when Catalyst
    pushes it down through projections."""
    return F.expr(passes_sql(dtypes, limits))


def failed_codes(reason: Column) -> Column:
    """``array<string>`` of the failed codes (empty when valid), derived from the reason text."""
    return F.coalesce(F.split(reason, REASON_SEPARATOR), F.array().cast("array<string>"))


def severity_sql(t: str = "temperature", p: str = "pressure", v: str = "vibration", limits: Limits = LIMITS) -> str:
    """CRITICAL > WARNING > NORMAL (strict ``>`` comparisons)."""
    crit = (f"{t} > {_num(limits.temperature_critical)} OR {v} > {_num(limits.vibration_critical)} "
            f"OR {p} > {_num(limits.pressure_critical)}")
    warn = (f"{t} > {_num(limits.temperature_alert)} OR {v} > {_num(limits.vibration_alert)} "
            f"OR {p} > {_num(limits.pressure_alert)}")
    return f"CASE WHEN {crit} THEN '{CRITICAL}' WHEN {warn} THEN '{WARNING}' ELSE '{NORMAL}' END"


def severity(limits: Limits = LIMITS) -> Column:
    return F.expr(severity_sql(limits=limits))


def alert_flags(limits: Limits = LIMITS) -> dict[str, Column]:
    return {
        "temperature_alert": F.expr(f"temperature > {_num(limits.temperature_alert)}"),
        "pressure_alert": F.expr(f"pressure > {_num(limits.pressure_alert)}"),
        "vibration_alert": F.expr(f"vibration > {_num(limits.vibration_alert)}"),
    }
