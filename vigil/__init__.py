"""vigil: machine-telemetry analytics as plain Spark DataFrame / Structured Streaming operators.

Layout:
  functions/  Column builders (rules, severity, formatting, exact rounding, time parsing)
  sources/    readers: telemetry projection of ``events``, JSON/Parquet scans, file-replay stream, Kafka options
  operators/  DataFrame -> DataFrame operators (quality, dedup, enrich, latest, consumers, windows, analytics)
  plans/      composed batch plans (bronze -> checked -> refined) and the query registry + SQL oracles
  streaming/  Structured Streaming launchers (bronze, refined foreachBatch, consumers, late-data)
"""

__version__ = "0.1.0"
