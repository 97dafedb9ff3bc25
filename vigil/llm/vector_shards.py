"""Searches of a query set against all vectors, in shards: the frame that op 3 and op 8 share.

Vectors are dealt by a hash of id and vector into shards of about SHARD rows, so the rows of a repeated id are spread;
equal rows, which cannot change a result, are sent once per batch and kept once per shard. A task holds the indexes of
at most SHARDS shards, and every batch's queries are sent to each task once, as one block. A block goes through the
task's shards with its best lists, so the kth score found in one shard bounds the search of the next. Tasks' best
lists meet in a top-k window per query (a map-side limit applies first).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, record_batch

SHARD = 4096
#: Shards of one task at most.
SHARDS = 16


def valid_vectors(col) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector; null and empty vectors and those with null or non-finite components
    are left out."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(col.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    out = []
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        m = values[first[rows][:, None] + np.arange(n)]
        good = np.isfinite(m).all(axis=1)
        out.append((rows[good], m[good]))
    return out


def _distinct(ids: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Places of the first of each equal (id, vector), in order."""
    h = mix(ids.astype(np.uint64))
    for j in range(m.shape[1]):
        h = mix(h * np.uint64(0xD1342543DE82EF95) + (m[:, j] + 0.0).view(np.uint64))
    return np.sort(np.unique(h, return_index=True)[1])


def _deal():
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, shard = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            asks = batch.column(3).to_numpy(zero_copy_only=False)
            for rows, m in valid_vectors(batch.column(1)):
                ask = np.flatnonzero(asks[rows])
                ask = ask[_distinct(ids[rows[ask]], m[ask])]
                one = _distinct(ids[rows], m)
                rows, asked, m = rows[one], (ids[rows[ask]], m[ask]), m[one]
                out = []
                order = np.argsort(shard[rows], kind="stable")
                cut = np.flatnonzero(np.diff(shard[rows][order], prepend=-1))
                for a, b in zip(cut, np.append(cut[1:], len(order))):
                    part = order[a:b]
                    out.append((m.shape[1], shard[rows[part[0]]], 0, ids[rows[part]].tobytes(), m[part].tobytes()))
                if len(ask):
                    out.append((m.shape[1], -1, 1, asked[0].tobytes(), asked[1].tobytes()))
                if out:
                    yield record_batch(schema, list(zip(*out)))
    return run


def merged(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (query, id, score) the ``k`` best different ids of each query, best first, ties to the smaller id."""
    low = ~score if score.dtype.kind == "i" else -score
    order = np.lexsort((low, ids, q))
    q, ids, score, low = q[order], ids[order], score[order], low[order]
    first = np.ones(len(q), bool)
    first[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score, low = q[first], ids[first], score[first], low[first]
    order = np.lexsort((ids, low, q))
    q, ids, score = q[order], ids[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], score[keep]


def _search(index: Callable, k: int, kind: str):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64() if kind == "double" else pa.int64())])
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64 if kind == "double" else np.int64)

    def run(batches):
        dim, shard, ids, parts, indexes = None, None, [], [], []

        def close():
            if parts:
                own, m = np.concatenate(ids), np.concatenate(parts)
                one = _distinct(own, m)
                indexes.append(index(own[one], m[one]))
            ids.clear()
            parts.clear()

        for batch in batches:
            for i in range(batch.num_rows):  # a row at a time, so that only one block is copied out of the batch
                row = batch.slice(i, 1).to_pylist()[0]
                if row["dim"] != dim:
                    ids.clear()
                    parts.clear()
                    indexes.clear()
                if (row["dim"], row["shard"]) != (dim, shard):
                    close()
                    dim, shard = row["dim"], row["shard"]
                own = np.frombuffer(row["ids"], np.int64)
                m = np.frombuffer(row["vectors"], np.float64).reshape(len(own), -1)
                if row["kind"] == 0:
                    ids.append(own)
                    parts.append(m)
                    if sum(map(len, ids)) > 4 * SHARD:  # equal rows that many batches sent
                        all_ids, all_m = np.concatenate(ids), np.concatenate(parts)
                        one = _distinct(all_ids, all_m)
                        ids[:], parts[:] = [all_ids[one]], [all_m[one]]
                    continue
                best = none
                for built in indexes:
                    names, n = np.unique(best[0], return_counts=True)
                    kth = dict(zip(names[n == k].tolist(), best[2][np.cumsum(n)[n == k] - 1].tolist()))
                    found = built(own, m, k, [kth.get(q) for q in own.tolist()])
                    best = merged(*[np.concatenate(x) for x in zip(best, found)], k)
                if len(best[0]):
                    yield record_batch(schema, list(best))
    return run


def top(vectors: DataFrame, asks: Column, k: int, index: Callable, kind: str, id_col: str, vector_col: str, shard: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all vectors for each row where ``asks`` is true.

    ``index(ids, matrix)`` makes a shard's index; called with (query ids, queries, k, floors) it returns columns
    query_id, vec_id and score of each query's best ``k`` different ids in the shard, without the query's own id; those below the
    query's floor (None: no floor yet) may be left out. Vectors meet those of their own length only. A null id takes no
    part; of rows with equal ids and queries the best score counts once.
    """
    own = vectors.where(F.col(id_col).isNotNull())
    shards = max(1, -(-own.count() // shard))
    # as few tasks as hold the shards, for every task gets all queries, but enough for all cores
    tasks = max(-(-shards // SHARDS), min(shards, vectors.sparkSession.sparkContext.defaultParallelism))
    own = own.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.pmod(F.xxhash64(id_col, vector_col), F.lit(shards)).cast("int").alias("shard"),
                     F.coalesce(asks, F.lit(False)).alias("asks"))
    dealt = own.mapInArrow(_deal(), "dim int, shard int, kind int, ids binary, vectors binary")
    to = F.expr(f"explode(CASE WHEN kind = 1 THEN sequence(0, {tasks - 1}) ELSE array(shard % {tasks}) END)").alias("task")
    found = (dealt.select("*", to).repartitionById(tasks, "task").sortWithinPartitions("dim", "kind", "shard").drop("task")
             .mapInArrow(_search(index, k, kind), f"query_id long, vec_id long, score {kind}")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
