"""Event-time windows (tumbling, sliding, session), moving averages over a bounded row frame, late-event flags.

Tumbling / sliding windows are keyed aggregates on ``window()`` (partial + final aggregation, skew-safe) and run
unchanged on streaming frames with a watermark. Batch sessions are built in one pass over chunks and a keyed
aggregate (``session_window`` would sort each device in one task); ``sessions_stream`` is the streaming form.
Row-frame operators never put a whole device in one task:
``moving_avg`` numbers each device's rows with the chunked prefix scan, cuts them into blocks of ``block`` rows and
copies the last ``n-1`` rows of each block into the next one as a halo, so each window group holds at most
``block + n - 1`` rows; ``late_flag`` uses an exclusive prefix max of the event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import exact
from vigil.operators import scan


def tumbling(df: DataFrame, width: str = "1 hour", ts: str = "event_timestamp", key: str = "device_id",
             value: str = "temperature") -> DataFrame:
    g = df.groupBy(F.window(F.col(ts), width).alias("w"), F.col(key)).agg(
        F.count(F.lit(1)).alias("n"), exact.exact_mean(F.col(value)).alias(f"avg_{value}"),
        F.max(value).alias(f"max_{value}"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n",
                    f"avg_{value}", f"max_{value}")


def sliding(df: DataFrame, width: str = "2 hours", slide: str = "1 hour", ts: str = "event_timestamp",
            key: str = "device_id") -> DataFrame:
    g = df.groupBy(F.window(F.col(ts), width, slide).alias("w"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


def sessions(df: DataFrame, gap: str = "6 hours", ts: str = "event_timestamp", key: str = "device_id",
             tiebreak: str = "arrival_seq") -> DataFrame:
    """Activity sessions per device: a new session starts when ``gap`` or more passed since the previous reading.

    Batch form in one pass over chunks cut by row count, so a device with a third of all readings, even within one day, is
    never sorted in one task. Within a chunk a reading's predecessor is the row before it; only a chunk's first reading
    needs the chunks before it. A table of one row per (device, chunk) tells whether that one starts a session and how
    many sessions started before; the session number is then a running count, and one keyed aggregate ends it. Same
    sessions as ``session_window`` (whose end is the last reading + gap); ``sessions_stream`` is the streaming form."""
    gap_us = f"CAST(unix_micros(CAST({ts} AS TIMESTAMP)) - unix_micros(CAST({ts} AS TIMESTAMP) - INTERVAL {gap}) AS BIGINT)"
    timed = df.filter(F.col(ts).isNotNull()).selectExpr(key, tiebreak, ts, f"unix_micros(CAST({ts} AS TIMESTAMP)) AS _t", f"{gap_us} AS _gap")
    chunks = scan.chunked_by_rows(timed, [key], "_t", tiebreak)
    order = f"OVER (PARTITION BY {key}, _blk ORDER BY _t, {tiebreak})"
    rows = chunks.withColumn("_new", F.expr(f"CAST(_t - lag(_t) {order} >= _gap AS BIGINT)"))  # null for a chunk's first reading
    parts = rows.groupBy(key, "_blk").agg(F.min_by("_gap", "_t").alias("_g"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.coalesce(F.sum("_new"), F.lit(0)).alias("_n"))
    before = f"OVER (PARTITION BY {key} ORDER BY _blk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    parts = parts.withColumn("_first", F.expr(f"CAST(coalesce(_lo - max(_hi) {before} >= _g, true) AS BIGINT)"))
    parts = parts.selectExpr(f"{key} AS _key", "_blk AS _chunk", "_first", f"coalesce(sum(_first + _n) {before}, 0) AS _had")
    joined = rows.join(parts, rows[key].eqNullSafe(parts["_key"]) & (rows["_blk"] == parts["_chunk"]))
    numbered = joined.withColumn("_sid", F.expr(f"_had + sum(coalesce(_new, _first)) {order}"))
    g = numbered.groupBy(key, "_sid").agg(F.expr(f"min({ts}) AS session_start"),
                                          F.expr(f"max({ts}) + INTERVAL {gap} AS session_end"),
                                          F.expr("count(1) AS n"))
    return g.select(key, "session_start", "session_end", "n")


def sessions_stream(df: DataFrame, gap: str = "6 hours", ts: str = "event_timestamp",
                    key: str = "device_id") -> DataFrame:
    """Streaming-legal sessions (``session_window``; needs a watermark on ``ts`` in append mode)."""
    g = df.groupBy(F.session_window(F.col(ts), gap).alias("s"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def moving_avg(df: DataFrame, n: int = 10, value: str = "temperature", key: str = "device_id",
               order: str = "arrival_seq", block: int | None = None, span: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Average of ``value`` over the last ``n`` rows of the same key (current row included), exact decimal sum; with the
    columns ``keep`` of each row. The rows are numbered once: a row near the end of its block is exploded into two, itself
    and its copy in the next block's halo."""
    block = max(block or (1 << 20), n)
    numbered = scan.sequence(df.select(key, order, value, *keep), key, order, "_idx", span=span)
    own = f"CAST((_idx - 1) div {block} AS BIGINT)"
    blocks = f"CASE WHEN (_idx - 1) % {block} >= {block - (n - 1)} THEN array({own}, {own} + 1) ELSE array({own}) END"
    rows = numbered.select("*", F.posexplode(F.expr(blocks)).alias("_halo", "_blk"))
    w = Window.partitionBy(key, "_blk").orderBy("_idx").rowsBetween(-(n - 1), 0)
    out = rows.select(key, order, *keep, "_halo",
                      F.sum(exact.dec2(F.col(value))).over(w).alias("_s"), F.count(F.col(value)).over(w).alias("_c"))
    return out.filter("_halo = 0").select(
        key, order, *keep, (F.col("_s").cast("double") / F.col("_c").cast("double")).alias(f"moving_avg_{value}"))


def moving_avg_range(df: DataFrame, minutes: int = 60, value: str = "temperature", key: str = "device_id", ts: str = "event_timestamp",
                     order: str = "arrival_seq") -> DataFrame:
    """Average of ``value`` over the readings of the same key of the last ``minutes`` (both ends and equal times
    included), exact decimal sums: the running sum up to a reading's time less the one before ``minutes`` earlier. Both
    come from one prefix scan, with chunks cut by row count, over a key's times (each with its sum and count) and the
    times that lie ``minutes`` before them, so no task holds all readings of a key, however close in time."""
    width = int(minutes) * 60_000_000
    timed = df.where(F.col(ts).isNotNull()).select(key, order, value, F.expr(f"unix_micros(CAST({ts} AS TIMESTAMP))").alias("_t"))
    times = timed.groupBy(key, "_t").agg(F.coalesce(F.sum(exact.dec2(F.col(value))), F.lit(0)).alias("_s"), F.count(F.col(value)).alias("_c"))
    # at equal times the start of a later window comes before the readings, which it includes
    points = times.select(key, "_t", F.explode(F.expr(f"array(struct(_t AS at, 1 AS up, _s AS s, _c AS c), struct(_t - {width} AS at, 0 AS up, _s * 0 AS s, 0L AS c))")).alias("_p"))
    points = points.select(key, "_t", F.expr("struct(_p.at, _p.up)").alias("_at"), F.col("_p.s").alias("_s"), F.col("_p.c").alias("_c"))
    sums = scan.running(points, key, "_at", {"_rs": ("sum", "_s"), "_rc": ("sum", "_c")}, by_rows=True)
    ends = sums.groupBy(F.col(key).alias("_key"), F.col("_t").alias("_time")).agg(*[F.expr(f"sum(CASE WHEN _at.up = 1 THEN _r{x} ELSE -_r{x} END) AS _w{x}") for x in "sc"])
    out = timed.join(ends, timed[key].eqNullSafe(ends["_key"]) & (timed["_t"] == ends["_time"]))
    return out.select(key, order, F.expr("CASE WHEN _wc > 0 THEN CAST(_ws AS DOUBLE) / CAST(_wc AS DOUBLE) END").alias(f"moving_avg_{value}"))


def late_flag(df: DataFrame, delay_minutes: int = 10, ts: str = "event_timestamp", key: str = "device_id",
              order: str = "arrival_seq", span: int | None = None) -> DataFrame:
    """``is_late``: event time below (latest event time seen earlier for the device - delay); NULL for a device's
    first reading."""
    prior = scan.running(df, key, order, {"_prior_max": ("max", F.col(ts))}, exclusive=True, span=span)
    limit = F.col("_prior_max") - F.expr(f"INTERVAL {int(delay_minutes)} MINUTES")
    return prior.withColumn("is_late", F.col(ts) < limit).drop("_prior_max")
