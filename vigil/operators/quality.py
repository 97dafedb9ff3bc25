"""Data-quality check and valid / invalid split (stateless; works on static and streaming frames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import rules


def check(df: DataFrame, limits: rules.Limits = rules.LIMITS, null_codes: bool = False) -> DataFrame:
    """Add ``error_reason`` (failed codes joined by ", ", NULL when valid) and ``is_valid`` (never NULL).

    One rule table defines both, so a NULL input fails its rule instead of vanishing from both sides."""
    dtypes = df.dtypes
    return df.withColumns({"is_valid": rules.passes(dtypes, limits),
                           "error_reason": rules.error_reason(dtypes, limits, null_codes)})


def with_failed_codes(checked: DataFrame) -> DataFrame:
    return checked.withColumn("failed_codes", rules.failed_codes(F.col("error_reason")))


def validity_label(df: DataFrame) -> DataFrame:
    return df.withColumn("dq_status", F.when(F.col("is_valid"), F.lit("VALID")).otherwise(F.lit("INVALID")))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). Every input row lands in exactly one side."""
    return checked.filter(F.col("is_valid")), checked.filter(~F.col("is_valid"))


def quarantine(invalid: DataFrame, payload_col: str | None = None) -> DataFrame:
    """Quarantine record: ids, reason, the payload as received (or the row as JSON), quarantine time."""
    payload = F.col(payload_col) if payload_col else F.to_json(F.struct(*[
        F.col(c) for c in invalid.columns if c not in ("is_valid", "error_reason", "value", "arrival_seq")]))
    keep = [c for c in ("arrival_seq",) if c in invalid.columns]
    return invalid.select(*keep, "event_id", "device_id", "error_reason",
                          payload.alias("original_payload"),
                          F.current_timestamp().alias("quarantine_timestamp"))


def split_counts(checked: DataFrame) -> DataFrame:
    """raw / valid / invalid counts in one aggregate (partial + final, no extra job per count)."""
    return checked.agg(F.count(F.lit(1)).alias("raw_count"),
                       F.count_if(F.col("is_valid")).alias("valid_count"),
                       F.count_if(~F.col("is_valid")).alias("invalid_count"))


def constraint_violations(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Integrity checks of a serving table: duplicate keys and NULLs in required columns, as one row.

    One keyed aggregate (partial, skew-safe) carries each key's count and NULL counts; one global sum ends it.
    NULL keys count as NULLs, not as duplicates of each other.
    """
    by_key = df.groupBy(key).agg(F.count(key).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])
    return by_key.agg(F.coalesce(F.sum(F.greatest(F.col("_n") - 1, F.lit(0))), F.lit(0)).cast("bigint").alias("duplicate_keys"),
                      *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).cast("bigint").alias(f"null_{c}") for c in required])
