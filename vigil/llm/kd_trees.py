"""Exact top-k inner products by KD-trees per shard.

A shard's tree splits at the median of its widest dimension down to leaves of LEAF vectors, and every node keeps the
tight bounding box of its vectors. The greatest inner product with anything in a box is the sum over dimensions of
the greater of q * low and q * high. A query visits nodes best bound first; the kth score of different ids, found here or
in a shard before, is carried along and ends the search at the first bound below it (at an equal one a smaller id may
still be found).
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame

from .vector_shards import SHARD, top

LEAF = 64
SCALE = 1024


def scaled(m: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): doubles as long as all inner products are exact in them, else Python integers."""
    out = np.floor(SCALE * m)
    if not len(out) or np.abs(out).max() < np.sqrt(2 ** 52 / out.shape[1]):
        return out
    with np.errstate(over="ignore"):
        big = np.isinf(out)
    return np.array([[SCALE * int(x) if b else int(y) for x, y, b in zip(r, s, t)] for r, s, t in zip(m.tolist(), out.tolist(), big.tolist())], object).reshape(m.shape)


class KDTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, scaled(vectors)
        self.low, self.high, self.nodes = [], [], []
        self._build(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.repeated = len(np.unique(ids)) < len(ids)

    def _build(self, rows: np.ndarray) -> int:
        m = self.vectors[rows]
        low, high = m.min(axis=0), m.max(axis=0)
        at = len(self.nodes)
        self.low.append(low)
        self.high.append(high)
        self.nodes.append(rows)
        wide = int(np.argmax(high - low))
        if len(rows) > LEAF and high[wide] > low[wide]:
            order = np.argsort(m[:, wide], kind="stable")
            half = len(rows) // 2
            self.nodes[at] = (self._build(rows[order[:half]]), self._build(rows[order[half:]]))
        return at

    def __call__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list | None = None):
        queries = scaled(queries)
        if queries.dtype != self.vectors.dtype or (len(queries) and queries.dtype != object and np.abs(queries).max() * np.abs(self.vectors).max() * queries.shape[1] >= 2 ** 53):
            queries, vectors = (x if x.dtype == object else x.astype(np.int64).astype(object) for x in (queries, self.vectors))
            low, high = (x if x.dtype == object else x.astype(np.int64).astype(object) for x in (self.low, self.high))
        else:
            vectors, low, high = self.vectors, self.low, self.high
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        out = []
        for i, q in enumerate(query_ids):
            bound, kth = bounds[i], floors[i] if floors else None
            if kth == -2 ** 63:  # a score below all longs is given as this one
                kth = None
            heap = [(-bound[0], 0)]
            ids, scores = np.zeros(0, np.int64), np.zeros(0, vectors.dtype)
            while heap and (kth is None or -heap[0][0] >= kth):
                node = self.nodes[heapq.heappop(heap)[1]]
                if isinstance(node, tuple):
                    for child in node:
                        heapq.heappush(heap, (-bound[child], child))
                    continue
                node = node[self.ids[node] != q]
                ids = np.concatenate([ids, self.ids[node]])
                scores = np.concatenate([scores, vectors[node] @ queries[i]])
                best = np.lexsort((ids, -scores))
                if self.repeated:  # the best row of each id
                    best = best[np.sort(np.unique(ids[best], return_index=True)[1])]
                best = best[:k]
                ids, scores = ids[best], scores[best]
                if k and len(ids) == k:
                    kth = scores[-1] if kth is None else max(kth, scores[-1])
            out.append((np.full(len(ids), q), ids, np.array([min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in scores], np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def exact_top(vectors: DataFrame, asks: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` greatest inner products of vectors floor(1024 * x), ties to
    the smaller id. Rows where ``asks`` is true are the queries; an id counts once, with its best row, for a query id's best row. Null and empty vectors, those with null or non-finite
    components and null ids take no part (zero vectors do); products beyond 64 bits are given as the nearest long; an
    empty table gives no rows; other columns are ignored."""
    return top(vectors, asks, k, KDTree, "long", id_col, vector_col, shard)
