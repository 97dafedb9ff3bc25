"""SentencePiece encoding by forward filtering and backward sampling over the piece lattice, and its decoding.

Forward: the summed weight of all segmentations up to each node of the trie of a group's distinct segments (see
lattice.py). Backward, for all occurrences together: from a segment's end an arc is drawn in proportion to the weight
that reaches it, then from its start, until the segment's beginning; so a whole segmentation is drawn with its exact
probability. The draws are a hash of (seed, row key, occurrence, step): a row's sample is the same in every run,
order and partitioning. Pieces stand for bytes, so decoding is lossless whatever is drawn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, list_array, mix, record_batch, text_buffers, text_groups
from .lattice import Lattice, PieceTrie, Vocabulary, lattices, segments


#: Bytes of texts, and ids, that a task samples or decodes at a time.
GROUP_TEXT, GROUP_IDS = 1 << 20, 1 << 19


def _sample(lattice: Lattice, logp: np.ndarray, ends: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(occurrence, step, piece) of segmentations drawn backwards from the nodes ``ends``; key: a hash per occurrence."""
    f = lattice.forward(logp)
    order = np.argsort(lattice.v, kind="stable")
    u, v, piece = lattice.u[order], lattice.v[order], lattice.piece[order]
    part = np.exp(f[u] + logp[piece] - f[v], where=np.isfinite(f[v]), out=np.zeros(len(v)))
    part[~np.isfinite(part)] = 0
    total = np.cumsum(part)
    first = np.searchsorted(v, np.arange(len(lattice.trie) + 1))
    before = np.concatenate([[0], total])[first[v]]
    where = v + np.minimum(total - before, 1)
    out = []
    node, at, step = ends, np.arange(len(ends)), 0
    while len(at):
        draw = (mix(key[at] + np.uint64(step * 0x9E3779B97F4A7C15 % 2 ** 64)) >> np.uint64(12)).astype(np.float64) / float(1 << 52)
        arc = np.clip(np.searchsorted(where, node + draw, "right"), first[node], first[node + 1] - 1)
        empty = part[arc] == 0  # by rounding at the upper end: the last arc with weight
        while empty.any():
            arc[empty] -= 1
            empty &= part[arc] == 0
        out.append((at.astype(np.int32), np.full(len(at), step, np.int32), piece[arc].astype(np.int32)))
        node = u[arc]
        at, node, step = at[node > 0], node[node > 0], step + 1
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int32),) * 3


def _encode(vocabulary: Vocabulary, logp: np.ndarray, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        pieces, hasher = PieceTrie(vocabulary), WordHasher(lower=False)
        for batch in batches:
            data, bounds = text_buffers(batch.column(2))
            row = mix(batch.column(1).to_numpy().view(np.uint64) + np.uint64(seed))
            for i, j in text_groups(bounds, GROUP_TEXT):
                own, which, cut = segments(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], hasher)
                text = np.repeat(np.arange(i, j), np.diff(cut))
                key = mix(row[text] ^ mix((np.arange(len(which)) - cut[text - i] + 1).astype(np.uint64)))
                count, drawn = np.zeros(len(which), np.int64), []
                by = np.argsort(which, kind="stable")
                spans = np.searchsorted(which[by], np.arange(len(own) + 1))
                for at, lattice in lattices(own, pieces):
                    times = spans[at + 1] - spans[at]
                    stop = np.cumsum(times)
                    places = by[np.repeat(spans[at] - (stop - times), times) + np.arange(int(stop[-1]))]
                    o, step, piece = _sample(lattice, logp, np.repeat(lattice.trie.ends, times), key[places])
                    o = places[o]
                    count += np.bincount(o, minlength=len(count))
                    drawn.append((o, step, piece))
                after = np.concatenate([[0], np.cumsum(count)])
                ids = np.zeros(int(after[-1]), np.int32)
                for o, step, piece in drawn:
                    ids[after[o + 1] - 1 - step] = piece
                ends = after[cut]
                yield record_batch(schema, [batch.column(0)[i:j], list_array([ids[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.int32())])
    return run


def _decode(vocabulary: Vocabulary):
    def run(batches):
        size = np.array([len(p) for p in vocabulary.pieces], np.int64)
        blob, first = np.frombuffer(b"".join(vocabulary.pieces), np.uint8), np.cumsum(size) - size
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            count = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids, texts = column.flatten().to_numpy(), []
            for i, j in text_groups(np.concatenate([[0], np.cumsum(count)]), GROUP_IDS):
                part = ids[count[:i].sum():count[:j].sum()]
                ends = np.cumsum(size[part])
                raw = blob[np.repeat(first[part] - (ends - size[part]), size[part]) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
                cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count[i:j])])].tolist()
                # without the space that encoding puts before a text
                texts += [raw[a + 1:b].decode(errors="replace") for a, b in zip(cut[:-1], cut[1:])]
            yield batch.append_column("text", pa.array([None if null else x for null, x in zip(column.is_null().to_pylist(), texts)], pa.string()))
    return run


def encode(docs: DataFrame, key: Column | None = None, seed: int = 0, theta: float = 1.0, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): one segmentation of every text, drawn with probability in proportion to the product
    of its pieces' weights to the power ``theta`` (the vocabulary's scores; 0: all segmentations alike).

    ``key`` (a long; default: a hash of the id) seeds a row's draws. Null and empty texts have no ids. Equal rows get
    equal samples; null ids are kept; other columns are ignored; an empty table gives no rows.
    """
    voc = Vocabulary(vocabulary)
    own = docs.select(F.col(id_col).cast("long").alias("doc"), (F.xxhash64(id_col) if key is None else F.coalesce(key.cast("long"), F.lit(0))).alias("key"), F.col(text_col).cast("string").alias("text"))
    logp = np.where(np.isfinite(voc.logp), voc.logp * theta, -np.inf)
    return own.mapInArrow(_encode(voc, logp, seed), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (with a column ids) and ``text``, exactly the text that was encoded ('' for null and empty ones;
    null for null ids)."""
    schema = encoded.schema
    return encoded.mapInArrow(_decode(Vocabulary(vocabulary)), type(schema)([*schema.fields]).add("text", "string"))
