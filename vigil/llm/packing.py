"""Best-fit packing by exact-complement hashing.

Which pieces share a sequence depends on their lengths only, and there are at most ``capacity`` lengths. So Spark
tokenises and counts pieces by length; the packing itself is planned on that histogram (its size does not depend on
the input) as patterns -- lists of lengths that a number of sequences have -- and every piece then finds its place by
its rank among the pieces of its length. Ranks are counted per part of a length, so a length that most pieces have is
spread over all tasks.

The plan goes through the lengths from the longest: it looks up the exact complement of the gap among single lengths,
then among sums of two and of three (under the counts that are left), and takes a combination as often as its counts
allow. What has no exact complement is packed best-fit: each goes to the fullest sequence that has room.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import ByteBPE
from .common import record_batch, save, text_buffers, text_groups

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
#: Texts tokenised at a time, in bytes: the tokenizer's arrays take some 40 bytes for each, beside other workers' and the JVM's.
GROUP = 1 << 20


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's text (about 1.5 MB, a fixed size), sent to the tasks with their code."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def _pair(left: np.ndarray, total: int) -> tuple[int, int] | None:
    """Lengths a >= b with a + b = total, a as large as possible."""
    if total < 2:
        return None
    b = np.arange(max(1, total - len(left) + 1), total // 2 + 1)
    a = total - b
    ok = np.flatnonzero((left[a] > 0) & (left[b] > (a == b)))
    return (int(a[ok[0]]), int(b[ok[0]])) if len(ok) else None


def _complement(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three lengths that fill the gap exactly; the caller has taken the length itself off ``left``."""
    if gap < len(left) and left[gap] > 0:
        return [gap]
    if pair := _pair(left, gap):
        return list(pair)
    for a in np.flatnonzero(left[:max(gap - 1, 0)])[::-1]:
        if 3 * a < gap:
            break
        left[a] -= 1
        pair = _pair(left[:a + 1], gap - int(a))
        left[a] += 1
        if pair:
            return [int(a), *pair]
    return None


def plan(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """[(lengths, number of sequences)] for counts[l] pieces of length l, 1 <= l < len(counts); capacity is the last l."""
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    out = [([capacity], int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    rest = np.zeros_like(left)
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            left[length] -= 1
            found = _complement(left, capacity - length)
            left[length] += 1
            if not found:
                rest[length], left[length] = left[length], 0
                break
            pattern = [length, *found]
            own, uses = np.unique(pattern, return_counts=True)
            times = int((left[own] // uses).min())
            left[own] -= uses * times
            out.append((pattern, times))
    bins: dict[int, list[list]] = {}  # open sequences by their gap
    for length in np.flatnonzero(rest)[::-1].tolist():
        todo = int(rest[length])
        while todo:
            gap = min((g for g in bins if g >= length), default=None)
            if gap is None:
                each = capacity // length
                full, todo = divmod(todo, each)
                for size, times in ((each, full), (todo, 1 if todo else 0)):
                    if times:
                        bins.setdefault(capacity - size * length, []).append([[length] * size, times])
                break
            pattern, times = bins[gap].pop()
            if not bins[gap]:
                del bins[gap]
            each = min(gap // length, todo)
            used = min(times, todo // each)
            if times > used:
                bins.setdefault(gap, []).append([pattern, times - used])
            bins.setdefault(gap - each * length, []).append([pattern + [length] * each, used])
            todo -= used * each
    return out + [(pattern, times) for group in bins.values() for pattern, times in group]


def places(patterns: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, sequence, offset) sorted by key = length << 44 | first rank: the piece of a length with rank r goes to
    sequence + (r - first rank) at offset, for the last first rank <= r."""
    following: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = following.get(length, 0)
            rows.append((length << 44 | rank, sequence, offset))
            following[length] = rank + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _cut(tokenizer: str, capacity: int, end: int, keep: bool):
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if keep else []))

    def run(batches):
        bpe = ByteBPE(tokenizer)
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for i, j in text_groups(bounds, GROUP):
                texts, rows = bpe(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]), []
                for doc, ids in zip(batch.column(0)[i:j].to_pylist(), texts):
                    ids = np.append(ids, np.int32(end))
                    first = (len(ids) - 1) % capacity + 1
                    for piece, start in enumerate(range(first - capacity, len(ids), capacity)):
                        part = ids[max(start, 0):start + capacity]
                        rows.append((doc, piece, max(start, 0), len(part), zlib.crc32(part.astype("<u4").tobytes()), *([part.tolist()] if keep else [])))
                yield record_batch(schema, list(zip(*rows)))
    return run


def _place(key: np.ndarray, sequence: np.ndarray, offset: np.ndarray):
    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            wanted = (length << 44) | rank
            at = np.searchsorted(key, wanted, "right") - 1
            own = [batch.column(c) for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence[at] + wanted - key[at]), pa.array(offset[at])],
                                             names=[c for c in batch.schema.names if c != "rank"] + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset): a row per piece of every row of ``docs``.

    A document's ids are its text's by the tokenizer (a null text's are those of the empty text: none) and then
    ``end``. Longer ones than ``capacity`` are cut into pieces of ``capacity``, of which the first may be shorter.
    Sequences are numbered from 0 without gaps; in each, offsets run from 0 without gaps. Repeated rows and ids are
    packed one by one; a null id is kept; other columns are ignored. An empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    pieces = own.mapInArrow(_cut(read_tokenizer(tokenizer), capacity, end, keep_ids), ddl)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = save(pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts))), "pieces", texts=True)

    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row.length] = row.n
    key, sequence, offset = places(plan(counts))
    before = sizes.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    own_rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("own", own_rank).join(before, ["length", "part"])
    columns = [c for c in pieces.columns if c != "part"]
    ranked = ranked.select(*columns, (F.col("before") + F.col("own")).alias("rank"))
    return ranked.mapInArrow(_place(key, sequence, offset), ddl + ", sequence_id long, offset long")
