"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X holds the centred vectors as rows. From orthonormal start directions V1 the process alternates P = X V (spread over
the rows) and Q = Xᵀ P (summed over the rows), and makes each orthogonal to all before it. That gives orthonormal U and V
with Uᵀ X V upper bidiagonal; the small matrix' singular values are X's, and its right singular vectors, by V, the
components. ``block`` directions go at a time (block bidiagonal; 1 is the plain process), which divides the passes over
the table; a pass does both products of a step.

U has a row per vector and is never stored. Every column of U is X times a short vector, U = X W, and of each the driver
keeps W and Z = Xᵀ U. So Uᵀ P = Wᵀ (Xᵀ P) needs the pass' sum alone, and U is made orthogonal in full like V, on d x block
matrices. The process ends when what is left of Q cannot change the components (``TOLERANCE`` of the largest singular value)
or nothing is left, with as many directions as dimensions at most.

What a task sends is a matrix of d x block numbers, summed by a keyed aggregate, not on the driver; the driver holds V, W
and Z. Vectors are read anew in each pass; nothing is cached, so a lost executor costs its tasks only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, record_batch
from .vector_shards import valid_vectors

SCALE, SHIFT = 1024, 100_000
#: Entries are held to whole numbers that doubles hold exactly.
LIMIT = 2.0 ** 53 - SHIFT
TOLERANCE = 1e-14
#: A share of the trace that sums of squares in doubles cannot tell from none.
NO_VARIANCE = 1e-13
LONG = (1 << 63) - 1

State = dict[int, dict]


def whole(m: np.ndarray) -> np.ndarray:
    """x = floor(1024 * c) + 100000 as int64."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * m), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S: int64 where it fits, else Python integers."""
    big = max((abs(s) for s in total), default=0) + n * (int(np.abs(x).max()) if x.size else 0)
    if big <= LONG:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def rows_of(x: np.ndarray, state: dict) -> np.ndarray:
    """Centred rows x - S / n in doubles."""
    return centred(x, state["n"], state["sums"]).astype(np.float64) / state["n"]


def _sums(vectors: DataFrame, part: Callable[[int, np.ndarray], list], kind: str) -> dict[int, list]:
    """Sums over all rows of the lists that ``part(dim, x)`` gives of the rows of a batch, by dimension. A task sends one
    list per dimension; a keyed aggregate adds them up."""
    schema = pa.schema([("dim", pa.int32()), ("part", pa.list_(pa.string() if kind != "double" else pa.float64()))])

    def run(batches):
        held: dict[int, list | np.ndarray] = {}
        for batch in batches:
            for _, m in valid_vectors(batch.column(0)):
                if len(m):
                    new = part(m.shape[1], whole(m))
                    old = held.get(m.shape[1])
                    held[m.shape[1]] = new if old is None else [a + b for a, b in zip(old, new)] if kind != "double" else old + new
        if held:
            yield record_batch(schema, [list(held), [[str(v) for v in x] if kind != "double" else x for x in held.values()]])

    parts = vectors.mapInArrow(run, f"dim int, part array<{'string' if kind != 'double' else 'double'}>")
    places = parts.select("dim", F.posexplode("part").alias("at", "v")).groupBy("dim", "at").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    out: dict[int, list] = {}
    for row in sorted(places.collect()):  # as many as a vector has entries, times the block
        out.setdefault(row.dim, []).append(row.v)
    return out


def _start(dim: int, size: int) -> np.ndarray:
    """Orthonormal start directions that depend on the dimension only."""
    draw = (mix(mix(np.arange(2 * dim * size, dtype=np.uint64)) + np.uint64(dim)) >> np.uint64(11)).astype(np.float64)
    u = (draw + 0.5) / float(1 << 53)
    g = np.sqrt(-2 * np.log(u[::2])) * np.cos(2 * np.pi * u[1::2])
    return np.linalg.qr(g.reshape(dim, size))[0]


def _orthonormal(m: np.ndarray) -> np.ndarray:
    """The nearly orthonormal columns of ``m`` made so to rounding, none turned round."""
    q, r = np.linalg.qr(m)
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


class Bidiagonal:
    """The process of one dimension, between passes: ``wanted()`` are the columns w of the next product X w."""

    def __init__(self, dim: int, block: int, components: int, trace: float):
        self.dim, self.components = dim, min(components, dim)
        self.scale = np.sqrt(trace)  # the Frobenius norm of X
        self.v = [_start(dim, min(block, dim))]
        self.w, self.z, self.a, self.s = [], [], [], []
        self.done = trace == 0

    def wanted(self) -> np.ndarray:
        out = self.v[-1]
        return out - self.w[-1] @ self.s[-1] if self.s else out

    def step(self, w: np.ndarray, z: np.ndarray, gram: np.ndarray) -> None:
        """``z`` = Xᵀ X w and ``gram`` = (X w)ᵀ (X w) of the pass over ``w``."""
        for _ in range(2):  # P less its part in all U before it
            for wi, zi in zip(self.w, self.z):
                c = wi.T @ z
                w, z, gram = w - wi @ c, z - zi @ c, gram - c.T @ c
        g, e = np.linalg.eigh((gram + gram.T) / 2)
        keep = g > NO_VARIANCE * self.scale ** 2
        if not keep.any():
            self.done = True
            self.v.pop()
            return
        root, e = np.sqrt(g[keep]), e[:, keep]
        self.a.append(root[:, None] * e.T)  # P = U a
        self.w.append(w @ e / root)
        self.z.append(z @ e / root)
        q = self.z[-1] - self.v[-1] @ self.a[-1].T
        basis = np.concatenate(self.v, axis=1)
        for _ in range(2):
            q = q - basis @ (basis.T @ q)
        left, r, right = np.linalg.svd(q, full_matrices=False)
        keep = (r > 1e-13 * self.scale) & (np.arange(len(r)) < self.dim - basis.shape[1])
        self.s.append((r[keep, None] * right[keep]).T)  # Q = V' sᵀ
        if not keep.any() or self.left_over() <= TOLERANCE:
            self.done = True
        else:
            new = left[:, keep]
            self.v.append(_orthonormal(new - basis @ (basis.T @ new)))

    def _svd(self):
        """Singular vectors and values of the block bidiagonal matrix Uᵀ X V."""
        at_u, at_v = np.cumsum([0] + [x.shape[0] for x in self.a]), np.cumsum([0] + [x.shape[1] for x in self.a])
        b = np.zeros((at_u[-1], at_v[-1]))
        for i, a in enumerate(self.a):
            b[at_u[i]:at_u[i + 1], at_v[i]:at_v[i + 1]] = a
            if i + 1 < len(self.a):
                b[at_u[i]:at_u[i + 1], at_v[i + 1]:at_v[i + 2]] = self.s[i]
        return np.linalg.svd(b, full_matrices=False)

    def left_over(self) -> float:
        """How far the components asked for are from invariant, by the largest singular value; more directions than
        components must be there to tell."""
        p, s, _ = self._svd()
        if len(s) < self.components:
            return np.inf
        return float(np.linalg.norm(self.s[-1].T @ p[-self.a[-1].shape[0]:, :self.components], axis=0).max() / s[0])

    def result(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(components as columns, variances), those of no variance left out; the greatest entry of each is positive."""
        if not self.a:
            return np.zeros((self.dim, 0)), np.zeros(0)
        _, s, yt = self._svd()
        c = np.concatenate(self.v[:len(self.a)], axis=1) @ yt.T
        keep = s[:self.components] ** 2 > NO_VARIANCE * self.scale ** 2
        c, s = c[:, :self.components][:, keep], s[:self.components][keep]
        c = _orthonormal(c)
        return c * np.sign(c[np.abs(c).argmax(axis=0), np.arange(c.shape[1])]), s * s / n


def fit(vectors: DataFrame, components: int = 8, block: int | None = None) -> State:
    """By dimension: n, sums (exact), trace, components (columns), variances and identity_error, of the one column of
    ``vectors``. Passes over the table: one for the sums, one for the trace, one per step, one for the error."""
    def totals(dim, x):
        return [len(x), *([int(v) for v in x.sum(axis=0)] if np.abs(x).max() * len(x) < 2.0 ** 62 else [int(v) for v in x.astype(object).sum(axis=0)])]

    state = {d: {"n": int(v[0]), "sums": [int(s) for s in v[1:]]} for d, v in _sums(vectors, totals, "decimal(38,0)").items()}
    at = {d: {"n": s["n"], "sums": s["sums"]} for d, s in state.items()}

    def squares(dim, x):
        return np.array([np.square(rows_of(x, at[dim])).sum()])

    for d, v in _sums(vectors, squares, "double").items():
        state[d]["trace"] = v[0]
    runs = {d: Bidiagonal(d, block or max(2 * components, -(-d // 8)), components, s["trace"]) for d, s in state.items()}
    while any(not r.done for r in runs.values()):
        ask = {d: r.wanted() for d, r in runs.items() if not r.done}

        def products(dim, x):
            if dim not in ask:
                return np.zeros(0)
            rows = rows_of(x, at[dim])
            p = rows @ ask[dim]
            return np.concatenate([(rows.T @ p).ravel(), (p.T @ p).ravel()])

        for d, v in _sums(vectors, products, "double").items():
            k = ask[d].shape[1]
            v = np.array(v)
            runs[d].step(ask[d], v[:d * k].reshape(d, k), v[d * k:].reshape(k, k))
    for d, r in runs.items():
        state[d]["components"], state[d]["variances"] = r.result(state[d]["n"])
    maps = {d: s["components"] / np.sqrt(s["variances"]) for d, s in state.items()}

    def second(dim, x):
        y = rows_of(x, at[dim]) @ maps[dim]
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    for d, v in _sums(vectors, second, "double").items():
        k, n, v = maps[d].shape[1], state[d]["n"], np.array(v)
        mean = v[k * k:] / n
        state[d]["identity_error"] = float(np.abs(v[:k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))
    return state


def deviations(c: np.ndarray) -> np.ndarray:
    """Sums of squares of the rows of n * x - S, exact; sums beyond 64 bits are the greatest long."""
    if c.dtype != object:
        near = np.square(c.astype(np.float64)).sum(axis=1)
        wrapped = np.square(c.astype(np.uint64)).sum(axis=1, dtype=np.uint64)  # exact where the sum is below 2^63
        if near.max(initial=0) < 2.0 ** 62:
            return wrapped.astype(np.int64)
        c = c.astype(object)
    return np.array([min(sum(int(v) ** 2 for v in row), LONG) for row in c], np.int64)


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", block: int | None = None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Entries c count as whole numbers x = floor(1024 * c) + 100000 (kept to 53 bits). Components are the unit eigenvectors of the
    covariance of all x-vectors (divisor n) by falling eigenvalue e, numbered from 1; of those without variance (fewer
    vectors than dimensions, constant entries; e below 1e-13 of the trace) there are no rows. deviation: sum of (n * x - S)^2, S the
    sums by dimension, exact up to the greatest long; whitened: x - S / n projected on the component, over sqrt(e);
    explained: e over the trace; identity_error: the largest entry of the whitened covariance less the identity,
    measured. Vectors that are null, empty or hold null or non-finite entries are left out; vectors of each length are a
    table of their own; null ids and equal rows are rows as all others; other columns are ignored; an empty table gives
    no rows."""
    state = fit(vectors.select(F.col(f"`{vector_col}`")), components, block)
    maps = {d: s["components"] / np.sqrt(s["variances"]) for d, s in state.items()}
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                        ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(1)
            for rows, m in valid_vectors(batch.column(0)):
                s = state.get(m.shape[1])
                if s is None or not len(m) or not len(s["variances"]):
                    continue
                k = len(s["variances"])
                c = centred(whole(m), s["n"], s["sums"])
                y = (c.astype(np.float64) / s["n"]) @ maps[m.shape[1]]
                yield record_batch(schema, [ids.take(pa.array(np.repeat(rows, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), len(m)), np.full(len(m) * k, s["n"]),
                                            np.repeat(deviations(c), k), y.ravel(), np.tile(s["variances"] / s["trace"] * s["n"], len(m)), np.full(len(m) * k, s["identity_error"])])

    return vectors.select(F.col(f"`{vector_col}`"), F.col(f"`{id_col}`").cast("long")).mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
