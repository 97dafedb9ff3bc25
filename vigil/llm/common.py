"""Helpers shared by the operators: scratch tables, Arrow text access, vectorised word hashes, streamed groups.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. They are hashed in numpy over whole Arrow buffers: a
prefix sum of table[byte] * B**position gives every word's polynomial hash from two lookups, so a text costs a few
nanoseconds a byte and never becomes a list of Python strings. Long texts are cut at word ends into segments, so the
working memory does not grow with a document; only 8 bytes per word do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import scratch_path

#: Texts handled at a time in one task, in bytes; a longer text is a group of its own.
GROUP_BYTES = 4 << 20
#: Broadcast a side only if its rows, counted, need no more than this.
BROADCAST_BYTES = 16 << 20
#: Bytes of rows sent to a Python worker at a time by save() of whole texts; Spark's own limit is 64 MB.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def save(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors. With ``texts``
    (whole texts pass through Python) rows go to the workers BATCH_BYTES at a time; the session's setting is put back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(BATCH)
    if texts:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        if texts:
            spark.conf.set(BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, width: int, text: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows, of ``width`` and the bytes of a column ``text``, fit
    BROADCAST_BYTES; else as it is, for a shuffled join."""
    if text is None:
        size = df.count() * width
    else:
        size = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + width)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijective finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of an Arrow string column; text i is bytes[bounds[i]:bounds[i + 1]], a null one is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    bounds = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_groups(bounds: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one text."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


class WordHasher:
    """64-bit hashes of all words of many texts; made inside a task."""

    #: Bytes hashed at a time; the arrays take some 50 bytes for each.
    SEGMENT = 1 << 18
    BASE = 0x9E3779B97F4A7C15

    def __init__(self, lower: bool):
        self.space = is_space()
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        if lower:  # A-Z hash as a-z
            self.table[65:91] = self.table[97:123]
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            size = -(-n // (1 << 14)) << 14
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def _cut(self, data: np.ndarray, bounds: np.ndarray, a: int) -> int:
        """End of the segment from ``a``: a text's end or a place beside white space."""
        b = a + self.SEGMENT
        if b >= len(data):
            return len(data)
        stop = int(bounds[np.searchsorted(bounds, b)])
        while b < stop:
            found = np.flatnonzero(self.space[data[b:min(b + self.SEGMENT, stop)]])
            if len(found):
                return b + int(found[0])
            b += self.SEGMENT
        return stop

    def __call__(self, data: np.ndarray, bounds: np.ndarray, places: bool = False):
        """(hashes, word bounds by text), and the words' first and last places with ``places``."""
        out, spots = [np.zeros(0, np.uint64)], [np.zeros((2, 0), np.int64)]
        counts = np.zeros(len(bounds) - 1, np.int64)
        a = 0
        while a < len(data):
            b = self._cut(data, bounds, a)
            seg = data[a:b]
            inner = bounds[np.searchsorted(bounds, a, "right"):np.searchsorted(bounds, b, "left")] - a
            solid = ~self.space[seg]
            first, last = solid.copy(), solid.copy()
            first[1:] &= ~solid[:-1]
            first[inner] = solid[inner]
            last[:-1] &= ~solid[1:]
            last[inner - 1] = solid[inner - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            self._powers(len(seg) + 1)
            total = np.zeros(len(seg) + 1, np.uint64)
            np.cumsum(self.table[seg] * self.power[:len(seg)], out=total[1:])
            out.append(mix((total[e] - total[s]) * self.inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
            counts += np.bincount(np.searchsorted(bounds, s + a, "right") - 1, minlength=len(counts))
            if places:
                spots.append(np.stack([s + a, e + a]))
            a = b
        woff = np.concatenate([[0], np.cumsum(counts)])
        return (np.concatenate(out), woff, np.concatenate(spots, axis=1)) if places else (np.concatenate(out), woff)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries of ``h`` (len(h) - k + 1 of them), whatever text they are in."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xF1357AEA2E62A9C5) + h[j:j + n]
    return mix(acc)


def window_mask(woff: np.ndarray, k: int) -> np.ndarray:
    """True where k entries from there lie in one text; as long as windows()."""
    n = int(woff[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(woff[1:], np.diff(woff))[:n]
    return np.arange(n) + k <= ends


def streamed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows with equal ``keys`` from batches sorted by them; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for name in keys:
            col = batch.column(name)
            if batch.num_rows > 1:
                change[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
        at = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            now = tuple(batch.column(name)[a].as_py() for name in keys)
            if held and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def list_array(values: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))
