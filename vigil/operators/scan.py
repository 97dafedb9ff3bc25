"""Skew-proof running aggregates per key ("prefix scans").

A plain ``Window.partitionBy(device).orderBy(arrival)`` sends every row of a device to one task; a device holding a
third of all readings would then be a third of the job in one task. Here each key's rows are cut into chunks by a
monotone bucket of the order column (``floor(order / span)``):

1. running aggregates inside each (key, chunk) with a window -> each window group has at most ``span`` order values;
2. chunk totals with a keyed aggregate (partial + final; the chunk table has one row per (key, chunk));
3. a running aggregate over the *small* chunk-total table per key (exclusive), giving each chunk's carry-in;
4. an equi-join back on (key, chunk) and a combine (sum: add, min: least, max: greatest).

``by_rows`` cuts chunks by row count instead, for orders that are not dense numbers (times, offsets of several
partitions): rows are written to the shared folder, range-partitioned by (key, order) from there and written with the
partition as the chunk. Chunks are then as large as partitions whatever the order's values, and the input is evaluated once.

sum / count / min / max are associative, so the result equals the single-window answer exactly (for decimals and
integers; for doubles sums are added in a different order). The rows are shuffled once, by (key, chunk); the totals
branch reads only the columns it aggregates and pre-aggregates before its shuffle; the chunk table is joined back by
(key, chunk) (AQE broadcasts it when it is small, measured at run time). When the input is a computed plan rather than
a stored table, Spark evaluates it for both branches (column pruning makes them differ, so the exchange is not
reused); over a stored refined table that is one extra column-pruned scan. Expressions are SQL text: one JVM call
each while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import scratch_path
from vigil.sources import fs

DEFAULT_SPAN = 1 << 22
SPAN_CONF = "spark.vigil.scan.span"
#: The chunk of rows without an order, before all others as null orders sort first.
NULL_CHUNK = -(1 << 63)


def default_span(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(SPAN_CONF, str(DEFAULT_SPAN)))


def chunked_by_rows(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """``df`` in the shared folder with ``_blk``, its chunk: range partitions by (keys, order), so a chunk's size follows
    the rows and not the order's values. ``df`` is computed once: it is written as it is, and the bounds are sampled from
    what was written. The number of chunks is that of the rows over ``default_span``, or of the shuffle partitions if larger."""
    spark = df.sparkSession
    plain, path = scratch_path(spark, "rows"), scratch_path(spark, "chunks")
    df.write.parquet(plain)
    stored = spark.read.schema(df.schema).parquet(plain)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // default_span(df)))
    dealt = stored.repartitionByRange(parts, *keys, *order).withColumn("_blk", F.spark_partition_id().cast("bigint"))
    dealt.write.parquet(path)
    fs.delete(spark, plain)
    return spark.read.schema(dealt.schema).parquet(path)


def _combine(kind: str, carry: str, inner: str) -> str:
    if kind == "sum":
        return f"CASE WHEN {carry} IS NULL THEN {inner} WHEN {inner} IS NULL THEN {carry} ELSE {carry} + {inner} END"
    return f"{'least' if kind == 'min' else 'greatest'}({carry}, {inner})"


def running(df: DataFrame, key: str | list[str], order: str, aggs: dict[str, tuple[str, str | Column]],
            exclusive: bool = False, span: int | None = None, tiebreak: str | None = None, by_rows: bool = False) -> DataFrame:
    """Add one column per ``aggs`` entry: ``name -> (kind, value)`` with kind in sum/min/max/peak (the greatest
    running sum so far; inclusive frames only) and value a SQL expression (or Column), aggregated over the rows of the same key up to and including the current row in
    ``order`` (``exclusive``: strictly before it).

    ``order`` (numeric; with ``by_rows`` any type) must be unique within a key for a deterministic frame, or be made
    unique by ``tiebreak``; without ``by_rows`` chunks are cut on ``order`` alone, so ties never straddle a boundary.
    Rows of a null ``order`` come first, in a chunk of their own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    span = span or default_span(df)
    peaks = {n for n, (kind, _) in aggs.items() if kind == "peak"}
    staged_cols: dict[str, Column] = {"_k": F.expr(f"struct({', '.join(keys)})")}
    if not by_rows:
        staged_cols["_blk"] = F.expr(f"coalesce(CAST(floor({order} / {float(span)!r}D) AS BIGINT), {NULL_CHUNK}L)")
    for name, (_, value) in aggs.items():
        staged_cols[f"_v_{name}"] = F.expr(value) if isinstance(value, str) else value
    staged = df.withColumns(staged_cols)
    if by_rows:
        staged = chunked_by_rows(staged, keys, order, *([tiebreak] if tiebreak else []))

    upper = "1 PRECEDING" if exclusive else "CURRENT ROW"
    sort = f"{order}, {tiebreak}" if tiebreak else order
    frame = f"PARTITION BY _k, _blk ORDER BY {sort} ROWS BETWEEN UNBOUNDED PRECEDING AND {upper}"
    plain = {n: "sum" if n in peaks else kind for n, (kind, _) in aggs.items()}
    inner = staged.withColumns({f"_in_{n}": F.expr(f"{kind}(_v_{n}) OVER ({frame})") for n, kind in plain.items()})
    if peaks:  # the running sum's own running maximum within the chunk, over the same frame
        inner = inner.withColumns({f"_pk_{n}": F.expr(f"max(_in_{n}) OVER ({frame})") for n in peaks})

    # a chunk's totals; its peak is that of its rows' running sums, so those are aggregated then
    totals = (inner if peaks else staged).groupBy("_k", "_blk").agg(
        *[F.expr(f"{kind}(_v_{n})").alias(f"_t_{n}") for n, kind in plain.items()],
        *[F.expr(f"max(_in_{n})").alias(f"_tp_{n}") for n in peaks])
    carry_frame = "PARTITION BY _k ORDER BY _blk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carry = totals.selectExpr("*", *[f"{kind}(_t_{n}) OVER ({carry_frame}) AS _c_{n}" for n, kind in plain.items()])
    carry = carry.selectExpr("_k", "_blk", *[f"_c_{n}" for n in plain],
                             *[f"max(coalesce(_c_{n}, 0) + _tp_{n}) OVER ({carry_frame}) AS _cp_{n}" for n in peaks])

    joined = inner.join(carry, on=["_k", "_blk"], how="inner")
    out = joined.withColumns({n: F.expr(f"greatest(_cp_{n}, coalesce(_c_{n}, 0) + _pk_{n})" if n in peaks else _combine(kind, f"_c_{n}", f"_in_{n}"))
                              for n, kind in plain.items()})
    return out.drop("_k", "_blk", *[f"_{p}_{n}" for n in aggs for p in ("v", "in", "c", "pk", "cp")])


def sequence(df: DataFrame, key: str | list[str] | None, order: str | list[str], name: str = "seq",
             span: int | None = None) -> DataFrame:
    """1-based row number in ``order`` per key (``key=None``: one global sequence), skew-proof. Several columns of
    ``order`` make a total order over partitions (time, partition, offset); chunks are then cut by rows."""
    one = df.withColumn("_one", F.lit(0)) if key is None else df
    columns = [order] if isinstance(order, str) else list(order)
    if len(columns) > 1:
        one = one.withColumn("_order", F.struct(*columns))
    out = running(one, "_one" if key is None else key, columns[0] if len(columns) == 1 else "_order", {name: ("sum", "CAST(1 AS BIGINT)")},
                  span=span, by_rows=len(columns) > 1)
    return out.drop("_one", "_order")
