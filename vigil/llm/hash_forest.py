"""Approximate nearest neighbours by a hash-prefix forest.

In every shard each of TREES trees is a sorted array of long hash strings (BITS signs of random projections, as one
integer). A query descends to its longest prefix match in every tree, and then all trees ascend together, a bit at a
time: at each level the vectors that share that many leading bits with the query in any tree are its candidates --
ranges of the sorted arrays, found by binary search -- until those other than the query's own id are FRACTION of the
shard and k ids, or all there are. Candidates are scored exactly. Nothing depends on the number of vectors but the number of shards, so recall does not fall as data grow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix
from .vector_shards import SHARD, top

TREES, BITS, FRACTION = 32, 24, 0.45


def projections(dim: int, trees: int, bits: int, seed: int = 0) -> np.ndarray:
    """Normal variates that depend on (seed, place) only."""
    n = dim * trees * bits
    draw = mix(mix(np.arange(2 * n, dtype=np.uint64)) + np.uint64(seed)) >> np.uint64(11)
    u = (draw.astype(np.float64) + 0.5) / float(1 << 53)
    return (np.sqrt(-2 * np.log(u[:n])) * np.cos(2 * np.pi * u[n:])).reshape(dim, trees * bits)


class HashForest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, fraction: float = FRACTION):
        length = np.sqrt((vectors * vectors).sum(axis=1))
        keep = length > 0
        self.ids, self.vectors, self.length = ids[keep], vectors[keep], length[keep]
        self.trees, self.bits, self.least = trees, bits, fraction * len(self.ids)
        self.repeated = len(np.unique(self.ids)) < len(self.ids)
        self.planes = projections(vectors.shape[1], trees, bits)
        hashes = self.hash(self.vectors)
        self.order = np.argsort(hashes, axis=0, kind="stable").T
        self.sorted = np.sort(hashes, axis=0).T

    def hash(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors @ self.planes > 0).reshape(len(vectors), self.trees, self.bits)
        return signs @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def count(self, rows: np.ndarray) -> int:
        """Different ids where ``rows`` is true."""
        return len(np.unique(self.ids[rows])) if self.repeated else int(rows.sum())

    def candidates(self, hashes: np.ndarray, query: int | None = None, k: int = 0) -> np.ndarray:
        """Of the deepest common level at which enough vectors, ``query``'s own not counted, share a prefix with it."""
        other = np.ones(len(self.ids), bool) if query is None else self.ids != query
        least, ids = min(self.least, other.sum()), min(k, self.count(other))

        def at(level: int) -> np.ndarray:
            low = hashes >> (self.bits - level) << (self.bits - level)
            high = low + (1 << (self.bits - level))
            seen = np.zeros(len(self.ids), bool)
            for t in range(self.trees):
                a, b = np.searchsorted(self.sorted[t], (low[t], high[t]))
                seen[self.order[t, a:b]] = True
            return seen

        deep, flat = self.bits + 1, 0  # ``flat`` has enough, ``deep`` has not
        found = None
        while deep - flat > 1:
            level = (deep + flat) // 2
            seen = at(level)
            if (seen & other).sum() >= least and self.count(seen & other) >= ids:
                flat, found = level, seen
            else:
                deep = level
        return np.flatnonzero(found) if found is not None else np.arange(len(self.ids))

    def __call__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list | None = None):
        out = []
        hashes, length = self.hash(queries), np.sqrt((queries * queries).sum(axis=1))
        for i, q in enumerate(query_ids):
            if not length[i] or not len(self.ids):
                continue
            c = self.candidates(hashes[i], q, k)
            c = c[self.ids[c] != q]
            score = (self.vectors[c] * queries[i]).sum(axis=1) / (self.length[c] * length[i])
            best = np.lexsort((self.ids[c], -score))
            if self.repeated:  # the best row of each id
                best = best[np.sort(np.unique(self.ids[c[best]], return_index=True)[1])]
            best = best[:k]
            if floors and floors[i] is not None:
                best = best[score[best] >= floors[i]]
            out.append((np.full(len(best), q), self.ids[c[best]], score[best]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(vectors: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, bits: int = BITS,
            fraction: float = FRACTION, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` vectors of largest cosine among its candidates, ties to
    the smaller id. Rows where ``asks`` is true are the queries. Null, empty and zero vectors, those with null or
    non-finite components and null ids take no part; an empty table gives no rows; other columns are ignored."""
    def index(ids, m):
        return HashForest(ids, m, trees, bits, fraction)

    return top(vectors, asks, k, index, "double", id_col, vector_col, shard)
