"""Exact decimal arithmetic for averages and rounding.

Readings carry two decimals, so sums are taken on ``decimal(18,2)`` (exact, order independent, identical on every
executor layout). A HALF_UP average to two decimals is computed from the integer sum of hundredths S and the count N
as ``(2|S| + N) div 2N`` with the sign of S re-applied: no intermediate rounding, so partial/final aggregation order
cannot change the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def dec2(c: Column) -> Column:
    return c.cast(MONEY)


def sum_hundredths(c: Column) -> Column:
    """Aggregate: integer sum of hundredths of ``c`` (NULLs ignored)."""
    return (F.sum(dec2(c)) * F.lit(100)).cast("bigint")


def half_up_avg2(s_hundredths: str, n: str) -> Column:
    """From the names of an integer sum of hundredths and a count: the HALF_UP average to 2 dp, as double."""
    return F.expr(half_up_avg2_sql(s_hundredths, n))


def exact_mean(c: Column) -> Column:
    """Aggregate: unrounded mean computed from the exact decimal sum (same in every engine)."""
    return F.sum(dec2(c)).cast("double") / F.count(c).cast("double")


# --- the same, as SQL text (one JVM call per expression when building plans) -----------------------------------

def sum_hundredths_sql(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) * 100 AS BIGINT)"


def hundredths_sql(x: str) -> str:
    """Per-row integer hundredths of a 2-dp reading (for running sums)."""
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def half_up_avg2_sql(s: str, n: str) -> str:
    return (f"CASE WHEN {n} > 0 THEN CAST(CASE WHEN {s} < 0 THEN -((-{s} * 2 + {n}) div ({n} * 2)) "
            f"ELSE ({s} * 2 + {n}) div ({n} * 2) END AS DOUBLE) / 100.0D END")


def exact_mean_sql(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / CAST(count({x}) AS DOUBLE)"
