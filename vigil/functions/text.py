"""Text builders: number rendering inside messages, reason lists, deterministic ids, topic names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num_sql(c: str) -> str:
    """Shortest round-trip decimal text of a double (``95.5``, ``100.0``), as Python's ``str(float)``."""
    return f"format_string('%s', CAST({c} AS DOUBLE))"


def fnum(x: float) -> str:
    """Driver-side rendering of a fixed limit, same convention as ``num``."""
    return repr(float(x))


def reason_list_sql(parts: list[tuple[str, str]]) -> str:
    """SQL: ``array<string>`` of the messages whose condition holds, in order. ``array_except(.., array(NULL))``
    drops the others and is code-generated (``array_compact`` is a lambda filter that falls back to interpreted
    evaluation); its set semantics are harmless because the messages of one list are all different."""
    cases = ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in parts)
    return f"array_except(array({cases}), array(CAST(NULL AS STRING)))"


def hash_id_sql(prefix: str, c: str) -> str:
    """Deterministic id: prefix + SHA-256 of the text in hex, whole (replays give the same id; no two texts share one)."""
    return f"concat('{prefix}', sha2(CAST({c} AS STRING), 256))"


def joined(c: Column, sep: str = "; ") -> Column:
    return F.concat_ws(sep, c)
