"""Texts dealt into chunks of a few MB, so that what all texts must learn of each other is sent per chunk, not per word.

A chunk asks with one blob of sorted distinct values per bucket of the value space; a bucket sees every chunk's blob
at once and answers each chunk with a blob. A value is sent once per chunk however often it occurs in it, so the most
frequent ones cost no more than rare ones, and buckets are even whatever the words' distribution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, sized

#: Text of a chunk, and values of a bucket, on average. Both are sizes, so their numbers follow the input.
CHUNK_BYTES = 4 << 20
BUCKET_VALUES = 1 << 20
#: What a row counts besides its text.
ROW_BYTES = 64

REQUEST = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("data", pa.binary())])
REQUEST_DDL = "bucket long, chunk long, keys binary, data binary"
ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("data", pa.binary())])
ANSWER_DDL = "chunk long, bucket long, keys binary, data binary"


def text_size(docs: DataFrame, text: Column) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def chunked(docs: DataFrame, size: int, *key: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` with a ``chunk`` number from the row's ``key`` columns, dealt out by it (all uses share one exchange).

    Rows with equal keys that are more than a chunk together are written once with a number, which deals them too."""
    n = max(1, -(-size // chunk_bytes))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same, nth = F.xxhash64(*key), F.lit(None).cast("long")
    row = F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES
    many = save(docs.groupBy(same.alias("same")).agg(F.count("*").alias("rows"), F.sum(row).alias("bytes")).where(f"rows > 1 and bytes > {chunk_bytes}").select("same"), "many") if n > 1 else None
    if many is not None and not many.isEmpty():
        many = sized(many, 16)
        repeated = save(docs.join(many, same == many.same, "left_semi").withColumn("nth", F.monotonically_increasing_id()), "repeated")
        docs, nth = docs.join(many, same == many.same, "left_anti").withColumn("nth", nth).union(repeated), F.col("nth")
    return docs.withColumn("chunk", F.pmod(F.xxhash64(*key, nth), F.lit(n))).drop("nth").repartition(parts, "chunk")


def requests(chunk: int, keys: np.ndarray, buckets: int, data: np.ndarray | None = None, width=np.uint64) -> pa.Table:
    """A row per bucket for sorted distinct uint64 ``keys``; only the low bits of ``width`` are sent."""
    b = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    b, keys = b[order], keys[order].astype(width)
    data = None if data is None else data[order]
    cut = np.flatnonzero(np.diff(b, prepend=-1))
    ends = np.append(cut[1:], len(b))
    return pa.Table.from_arrays([
        pa.array(b[cut]), pa.array(np.full(len(cut), chunk)), pa.array([keys[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()),
        pa.array([None if data is None else data[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())], schema=REQUEST)


def blobs(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) if x is not None else np.zeros(0, kind) for x in table.column(name).to_pylist()]


def whole(keys: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Names uint32 keys by their bucket too."""
    return keys.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
